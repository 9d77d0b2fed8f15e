"""Operator 8: benchmark decontamination by template, in DataFrame operations only.

Numbers, names and units become typed placeholders, so that a question with other parameters has the same
template. A capitalised word that may just start a sentence is hashed in both ways, as a word and as a name.
Windows of the template's words are hashed and hash-joined with the windows of the benchmark items. Of a document and
an item that meet, every alignment is cut into runs of windows that touch. Within a run a slot value of the item stands
for one value of the document, the most frequent one; windows with other values do not count. A document is
contaminated by an item if what is left holds at least ``coverage`` of the item's windows, or so many words in a row
that the item's length does not matter: ``same_words`` unchanged ones or ``run_words`` of the template. ``exact``
tells an unchanged copy from a re-parameterised one.

A null text has no words. Items shorter than a window, and windows with fewer than ``literals`` words that are
not placeholders, are not searched for. Repeated items each count; repeated rows of a document (id and text) are
reported once, and ``clean`` removes them all. Null ids are allowed; an
empty table on either side gives an empty result; further columns are ignored by ``matches`` and kept by ``clean``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namebridge.llm.stages import documents, written


@dataclass(frozen=True)
class TemplateConfig:
    window: int = 8
    literals: int = 4
    #: Share of an item's windows that a document must hold.
    coverage: float = 0.5
    #: Or words in a row, whatever the item's length: unchanged ones, and those of the template.
    same_words: int = 13
    run_words: int = 20
    #: Rows of 8 to 40 bytes up to which a side is broadcast; beyond it the join is a shuffle.
    broadcast_rows: int = 200_000


#: Unit words after a number. Fixed values.
UNITS = ("km", "m", "cm", "mm", "mi", "miles?", "feet", "ft", "inch(?:es)?", "kg", "g", "mg", "lbs?", "pounds?",
         "ounces?", "l", "ml", "lit(?:er|re)s?", "met(?:er|re)s?", "grams?", "s", "sec(?:ond)?s?", "min(?:ute)?s?",
         "h", "hours?", "days?", "weeks?", "months?", "years?", "%", "percent", "dollars?", "euros?", "cents?",
         "degrees?", "mph", "kmh", "watts?", "volts?")
# The patterns look back from a match's first character, so that most positions fail at one comparison.
_NUMBER = r"[0-9](?<![\p{L}\p{N}][0-9])[0-9]*(?:[.,]+[0-9]+)*"
_UNIT = r"(?i)(?<=\x01d\x02|[0-9]\x02)(\s?)(" + "|".join(UNITS) + r")(?![\p{L}\p{N}])"
#: A capitalised word. Group 1: the blank before it, if that follows something other than the end of a sentence (a name).
#: Otherwise it is a name or the first word of a sentence.
#: Nothing behind the group can fail: Java keeps a group of a failed attempt.
_CAPITAL = r"\p{Lu}(?<![\p{L}\p{N}]\p{Lu})\p{Ll}(?:(?<=[^.!?:\s](\s)\p{Lu}\p{Ll})|)\p{L}*"
_TOKEN = r"[a-z0-9\p{L}\p{N}]+|\x01[^\x02]*\x02"


def _lit(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def tokens(text: Column, values: bool) -> Column:
    """The words of a text, placeholders as \\x01 kind [value] \\x02. Kind s, always with its value, is a word or a name."""
    keep = "$0" if values else ""
    t = F.coalesce(text, F.lit(""))
    marks = t.contains("\x01") | t.contains("\x02")
    t = F.when(marks, F.translate(t, "\x01\x02", "  ")).otherwise(t)
    t = F.regexp_replace(t, _CAPITAL, "\x01$1s$0\x02")
    # A unit only counts after a number, so a text without a digit needs neither pass.
    numbers = F.regexp_replace(t, _NUMBER, f" \x01d{keep}\x02")
    units = F.regexp_replace(numbers, _UNIT, f"$1\x01u{'$2' if values else ''}\x02")
    found = F.regexp_extract_all(F.lower(F.when(text.rlike("[0-9]"), units).otherwise(t)), F.lit(_TOKEN), F.lit(0))
    name = (lambda x: F.concat(F.lit("\x01n"), F.substring(x, 4, 1 << 30))) if values else (lambda x: F.lit("\x01n\x02"))
    return F.transform(found, lambda x: F.when(
        x.startswith("\x01") & ~F.substring(x, 2, 1).isin("d", "s", "u"), name(x)).otherwise(x))


def plain(words: str) -> str:
    """SQL for tokens without their values."""
    return f"transform({words}, x -> if(startswith(x, '\x01') and not startswith(x, '\x01s'), concat(substring(x, 1, 2), '\x02'), x))"


def value(word: str) -> str:
    """SQL for the text that a token stands for."""
    return f"if(startswith({word}, '\x01'), substring({word}, 3, length({word}) - 3), {word})"


def _chained(a: str, n: int) -> str:
    """SQL for the hashes of n entries in a row of an array of hashes, made from those of half as many."""
    if n == 1:
        return a
    half, count = n // 2, f"greatest(size({a}) - {n - 1}, 0)"
    part = f"b{n}"
    both = f"zip_with(slice({part}, 1, {count}), slice({part}, {half + 1}, {count}), (x, y) -> xxhash64(x, y))"
    if n % 2:
        both = f"zip_with({both}, slice({a}, {n}, {count}), (x, y) -> xxhash64(x, y))"
    return f"transform(array({_chained(a, half)}), {part} -> {both})[0]"


def windows(words: str, config: TemplateConfig) -> Column:
    """Hashes of the windows of an array of template words.

    First those with all words of kind s as words; then, where there are such words, as many with all of them as names,
    null for windows without such a word, which would only repeat the first.
    """
    n = config.window
    as_word = f"transform({words}, x -> xxhash64(if(startswith(x, '\x01s'), {value('x')}, x)))"
    as_name = f"zip_with({words}, w, (x, h) -> if(startswith(x, '\x01s'), xxhash64('\x01n\x02'), h))"
    return F.expr(f"""
        case when size({words}) < {n} then cast(array() as array<bigint>)
        when exists({words}, x -> startswith(x, '\x01s'))
          then transform(array(transform(transform(array({as_word}), w -> array(w, {as_name}))[0], a -> {_chained("a", n)})), v ->
            concat(v[0], zip_with(v[0], v[1], (x, y) -> if(x = y, null, y))))[0]
        else transform(array({as_word}), a -> {_chained("a", n)})[0] end""")


def parts(words: str, config: TemplateConfig, step: int) -> Column:
    """Hashes of half windows of an array of template words, at every ``step``-th place.

    As with ``windows``, words of kind s are all words, then all names. Equal windows have equal halves at all places, and each
    window holds one that starts at a multiple of ``part_step``: a text without an item's half has no window of an item.
    """
    n, half = config.window, _half(config)
    as_word = f"transform({words}, x -> if(startswith(x, '\x01s'), {value('x')}, x))"
    as_name = f"transform({words}, x -> if(startswith(x, '\x01s'), '\x01n\x02', x))"

    def hashes(form: str) -> str:
        run = ", ".join(f"p[i + {k}]" for k in range(half))
        return f"transform(array({form}), p -> transform(sequence(0, size({words}) - {half}, {step}), i -> xxhash64({run})))[0]"

    return F.expr(f"""
        case when size({words}) < {n} then cast(array() as array<bigint>)
        when exists({words}, x -> startswith(x, '\x01s')) then concat({hashes(as_word)}, {hashes(as_name)})
        else {hashes(words)} end""")


def _half(config: TemplateConfig) -> int:
    return max(1, config.window // 2)


def part_step(config: TemplateConfig) -> int:
    return config.window - _half(config) + 1


def _literal(hashes: str, words: str, config: TemplateConfig) -> Column:
    """``windows`` with null for those with too few literals. A text's windows need no such test to meet an item's."""
    n = config.window
    return F.expr(f"""
        transform({hashes}, (h, k) -> if({config.literals} <= size(filter(
          slice({words}, cast(k % (size({words}) - {n - 1}) as int) + 1, {n}),
          x -> not startswith(x, '\x01') or (k <= size({words}) - {n} and startswith(x, '\x01s')))), h, null))""")


def _place(at: str, words: str, config: TemplateConfig) -> Column:
    """The place of a window in its text from its place among ``windows``."""
    return F.expr(f"cast({at} % ({words} - {config.window - 1}) as int)")


def _longest(run: str, config: TemplateConfig) -> str:
    """SQL for the longest stretch of words that windows, in order, cover without a gap."""
    n = config.window
    return f"""aggregate({run}, struct(-1 as head, -1 as last, 0 as most), (a, w) ->
        transform(array(if(a.head < 0 or w.q - a.last > {n}, w.q, a.head)), head ->
          struct(head as head, w.q as last, greatest(a.most, w.q - head + {n}) as most))[0], a -> a.most)"""


def _sized(df: DataFrame, rows: int) -> DataFrame:
    """df to be broadcast if it has few rows, as counted; as it is otherwise."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _items(benchmark: DataFrame, config: TemplateConfig) -> DataFrame:
    """uid, item_id, words with values, template windows and their number."""
    t = benchmark.select(F.monotonically_increasing_id().alias("item"), "item_id", tokens(F.col("text"), True).alias("iv"))
    t = t.withColumn("it", F.expr(plain("iv")))
    t = t.withColumn("iw", windows("it", config)).withColumn("iw", _literal("iw", "it", config))
    t = t.withColumn("total", F.expr(
        f"size(array_distinct(filter(slice(iw, 1, greatest(0, size(it) - {config.window - 1})), x -> x is not null)))"))
    t = t.where("total > 0").withColumn("ip", parts("it", config, 1))
    return written(t.drop("it"), "items")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64("doc_id", text).alias("h"), F.octet_length(text).alias("size"), "text")


def _candidates(rows: DataFrame, items: DataFrame, config: TemplateConfig) -> DataFrame:
    """The rows that hold half a window of an item: all others have no window of one."""
    keys = _sized(items.select(F.explode("ip").alias("w")).distinct(), config.broadcast_rows)
    words = rows.select("h", "size", tokens(F.col("text"), False).alias("words"))
    near = words.select("h", "size", F.explode(parts("words", config, part_step(config))).alias("w")).join(keys, "w")
    near = written(near.select("h", "size").distinct(), "near")
    return written(rows.join(_sized(near, config.broadcast_rows), ["h", "size"]), "candidates")


def matches(docs: DataFrame, benchmark: DataFrame, config: TemplateConfig | None = None) -> DataFrame:
    """h, size (which name a text and its id), doc_id, item_id, n_windows, total_windows, exact of all leaks."""
    config = config or TemplateConfig()
    items = _items(benchmark, config)
    # q: place of a window; c: its first hash, which names equal windows.
    places = items.select("item", "iw", F.size("iv").alias("size"), F.posexplode("iw").alias("at", "w")).where("w is not null") \
        .withColumn("q", _place("at", "size", config)).select("item", "q", F.expr("iw[q]").alias("c"), "w")
    keys = _sized(places.select("w").distinct(), config.broadcast_rows)
    rows = _candidates(_keyed(docs), items, config)
    words = rows.select("doc_id", "h", "size", tokens(F.col("text"), False).alias("words"))
    found = words.select("doc_id", "h", "size", F.size("words").alias("n"), F.posexplode(windows("words", config)).alias("at", "w")) \
        .where("w is not null").join(keys, "w").withColumn("p", _place("at", "n", config))
    found = written(found.select("doc_id", "h", "size", "p", "w").distinct(), "windows")
    pairs = found.join(_sized(places, config.broadcast_rows), "w")
    totals = items.select("item", "item_id", "total", "iv")
    light = _sized(totals.select("item", "total"), config.broadcast_rows)
    # Only pairs with enough windows, or with a long enough stretch, go on to their texts.
    covered = pairs.groupBy("h", "size", "item").agg(F.countDistinct("c").alias("n")).join(light, "item") \
        .where(F.col("n") >= config.coverage * F.col("total")).select("h", "size", "item")
    least = min(config.same_words, config.run_words)
    long = pairs.groupBy("h", "size", "item", (F.col("p") - F.col("q")).alias("shift")).agg(
        (F.max("q") - F.min("q") + config.window).alias("n")).where(F.col("n") >= least).select("h", "size", "item")
    enough = written(covered.union(long).distinct(), "pairs")
    wanted = _sized(enough.select("h", "size").distinct(), config.broadcast_rows)
    values = rows.join(wanted, ["h", "size"]).select(
        "h", "size", tokens(F.col("text"), True).alias("dv")).dropDuplicates(["h", "size"])
    placed = pairs.join(enough, ["h", "size", "item"]).select(
        "h", "size", "item", F.struct("q", "c").alias("window"), (F.col("p") - F.col("q")).alias("shift")).distinct()
    aligned = placed.groupBy("h", "size", "item", "shift").agg(F.array_sort(F.collect_set("window")).alias("windows"))
    n = config.window
    # A run ends where the next window does not touch it. Its pairs of values, with the place in the item.
    runs = aligned.select("h", "size", "item", "shift", "windows", F.expr(f"""
            filter(sequence(0, size(windows) - 1), k -> k = 0 or windows[k].q - windows[k - 1].q > {n})""").alias("heads")) \
        .select("h", "size", "item", "shift", F.explode(F.expr("""
            transform(heads, (a, k) -> slice(windows, a + 1, coalesce(get(heads, k + 1), size(windows)) - a))""")).alias("run"))
    slots = runs.join(values, ["h", "size"]).join(totals, "item").select(
        "h", "size", "item", "item_id", "total", "run", F.expr(f"""
            transform(filter(array_distinct(flatten(transform(run, w -> sequence(w.q, w.q + {n - 1})))),
              k -> startswith(iv[k], '\x01')), k -> struct(k as k, {value("iv[k]")} as i, {value("dv[k + shift]")} as d))
            """).alias("slots"))
    # For each value of the item its most frequent value in the document, of equally frequent ones the first.
    main = """map_from_entries(transform(array_distinct(transform(slots, s -> s.i)), i ->
        transform(array(filter(slots, s -> s.i = i)), own -> struct(i, array_max(transform(own, y ->
          struct(size(filter(own, z -> z.d = y.d)) as n, -y.k as first, y.d as d))).d as d))[0]))"""
    slots = slots.withColumn("odd", F.expr(f"""
        case when size(array_distinct(transform(slots, s -> struct(s.i, s.d)))) = size(array_distinct(transform(slots, s -> s.i)))
          then filter(slots, s -> false)
        else transform(array({main}), m -> filter(slots, s -> s.d != m[s.i]))[0] end"""))
    slots = slots.withColumn("run", F.expr(f"""
        filter(run, w -> not exists(odd, s -> s.k between w.q and w.q + {n - 1}))"""))
    slots = slots.withColumn("same", F.expr(f"""
        forall(slots, s -> s.i = s.d or not exists(run, w -> s.k between w.q and w.q + {n - 1}))"""))
    # Stretches of words that the windows left in a run cover, and those of them without other values.
    slots = slots.where("size(run) > 0").withColumns({
        "template": F.expr(_longest("run", config)),
        "unchanged": F.expr(_longest(f"""filter(run, w -> not exists(slots, s ->
            s.k between w.q and w.q + {n - 1} and s.i != s.d))""", config))})
    leaks = slots.groupBy("h", "size", "item", "item_id", "total").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("run.c")))).alias("n_windows"), F.min("same").alias("exact"),
        F.max("template").alias("template"), F.max("unchanged").alias("unchanged")) \
        .where((F.col("n_windows") >= config.coverage * F.col("total"))
               | (F.col("template") >= config.run_words) | (F.col("unchanged") >= config.same_words))
    ids = found.select("h", "size", "doc_id").distinct()
    return leaks.join(ids, ["h", "size"]).select(
        "h", "size", "doc_id", "item_id", F.col("n_windows").cast("long").alias("n_windows"),
        F.col("total").cast("long").alias("total_windows"), "exact")


def clean(docs: DataFrame, benchmark: DataFrame, config: TemplateConfig | None = None) -> DataFrame:
    """docs without contaminated rows."""
    config = config or TemplateConfig()
    leaks = written(matches(docs, benchmark, config).select("h", "size").distinct(), "leaks")
    text = F.coalesce("text", F.lit(""))
    rows = docs.withColumns({"_llm_h": F.xxhash64("doc_id", text), "_llm_n": F.octet_length(text)})
    leaks = _sized(leaks.toDF("_llm_h", "_llm_n"), config.broadcast_rows)
    return rows.join(leaks, ["_llm_h", "_llm_n"], "left_anti").drop("_llm_h", "_llm_n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matches(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "item_id", "n_windows", "total_windows", "exact")
