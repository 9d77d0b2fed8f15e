"""Operator 5: license scan by ordered signature rules, in DataFrame operations only.

A rule has an anchor word, a keyword, a regex for the words that end before the anchor and one for those that
follow, a label and a priority. Texts without any anchor's stem are passed over. Around every anchor the words
of a fixed window are kept, and a hash join on (anchor, keyword) gives each place the few rules that can match
there. A detection that lies within one of higher priority (or of the same priority and longer) is suppressed.

A null text has no words. Repeated rows and equal texts get equal results; null ids are allowed; further columns are
ignored; an empty table gives an empty result. Ties between equal intervals of equal priority go to the first
label in alphabetical order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namebridge.llm.stages import documents, written

#: Words looked at on either side of an anchor; no rule spans more.
REACH = 12
#: Confidence by priority. Fixed values.
CONFIDENCE = {0: 0.4, 1: 0.5, 2: 0.7, 3: 0.8, 4: 0.9, 5: 0.95}

# Label, keyword, name before the word "license", versions.
FAMILIES = [
    ("apache", "apache", "apache(?: software)?", "1.0 1.1 2.0"),
    ("mit", "mit", "mit(?: expat| x11)?", ""),
    ("gpl", "general", "(?:gnu )?general public", "1.0 2.0 3.0"),
    ("lgpl", "lesser", "(?:gnu )?lesser general public", "2.1 3.0"),
    ("lgpl", "library", "(?:gnu )?library general public", "2.0 2.1"),
    ("agpl", "affero", "(?:gnu )?affero general public", "1.0 3.0"),
    ("gfdl", "documentation", "(?:gnu )?free documentation", "1.1 1.2 1.3"),
    ("mpl", "mozilla", "mozilla public", "1.0 1.1 2.0"),
    ("epl", "eclipse", "eclipse public", "1.0 2.0"),
    ("cpl", "common", "common public", "1.0"),
    ("cddl", "distribution", "common development and distribution", "1.0 1.1"),
    ("bsd-0-clause", "bsd", "(?:zero|0) clause bsd", ""),
    ("bsd-2-clause", "bsd", "(?:simplified|2 clause|freebsd) bsd", ""),
    ("bsd-3-clause", "bsd", "(?:new|modified|revised|3 clause) bsd", ""),
    ("bsd-4-clause", "bsd", "(?:original|old|4 clause) bsd", ""),
    ("bsd", "bsd", "bsd(?: style)?", ""),
    ("isc", "isc", "isc", ""),
    ("zlib", "zlib", "zlib(?: libpng)?", ""),
    ("bsl", "boost", "boost software", "1.0"),
    ("artistic", "artistic", "artistic", "1.0 2.0"),
    ("psf", "python", "python(?: software foundation)?", "2.0"),
    ("php", "php", "php", "3.0 3.01"),
    ("ruby", "ruby", "ruby", ""),
    ("postgresql", "postgresql", "postgresql", ""),
    ("osl", "open", "open software", "1.0 1.1 2.0 2.1 3.0"),
    ("afl", "academic", "academic free", "1.1 1.2 2.0 2.1 3.0"),
    ("eupl", "european", "european union public", "1.0 1.1 1.2"),
    ("cecill", "cecill", "cecill(?: free software)?", "1.0 2.0 2.1"),
    ("ofl", "font", "(?:sil )?open font", "1.0 1.1"),
    ("odbl", "database", "open(?: data commons open)? database", "1.0"),
    ("odc-by", "attribution", "open data commons attribution", "1.0"),
    ("ms-pl", "microsoft", "microsoft public", ""),
    ("ms-rl", "microsoft", "microsoft reciprocal", ""),
    ("ipl", "ibm", "ibm public", "1.0"),
    ("apsl", "apple", "apple public source", "1.0 1.1 1.2 2.0"),
    ("upl", "permissive", "universal permissive", "1.0"),
    ("ecl", "educational", "educational community", "1.0 2.0"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)?", ""),
    ("wtfpl", "want", "do what the f[a-z]* you want to public", "1.0 2.0"),
    ("beerware", "beerware", "beerware", ""),
    ("vim", "vim", "vim", ""),
    ("json", "json", "json", ""),
    ("openssl", "openssl", "openssl", ""),
    ("sleepycat", "sleepycat", "sleepycat", ""),
    ("qpl", "q", "q public", "1.0"),
    ("lppl", "latex", "latex project public", "1.0 1.1 1.2 1.3"),
    ("nasa", "nasa", "nasa open source", "1.3"),
    ("spl", "sun", "sun public", "1.0"),
    ("elastic", "elastic", "elastic", "1.0 2.0"),
    ("busl", "business", "business source", "1.0 1.1"),
    ("sspl", "server", "server side public", "1.0"),
    ("w3c", "w3c", "w3c(?: software)?", ""),
    ("zpl", "zope", "zope public", "1.1 2.0 2.1"),
    ("ncl", "non", "non commercial", ""),
]
#: Creative Commons variants: label, words after "by", words of the long name.
CREATIVE = [
    ("cc-by", "", "attribution"),
    ("cc-by-sa", " sa", "attribution share ?alike"),
    ("cc-by-nd", " nd", "attribution no ?deriv(?:ative)?s(?: works)?"),
    ("cc-by-nc", " nc", "attribution non ?commercial"),
    ("cc-by-nc-sa", " nc sa", "attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", " nc nd", "attribution non ?commercial no ?deriv(?:ative)?s(?: works)?"),
]
CREATIVE_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
_GRANT = "(?:licensed|released|available|distributed|published|provided|covered) (?:under|by)(?: the)?(?: terms of)?(?: the)? "
_LATER = "(?: of the license)? or (?:\\(?at your option\\)? )?(?:any )?(?:later|newer)(?: version)?"


def _version(version: str) -> str:
    """Words of a version; a trailing zero may be left out."""
    major, minor = version.split(".")
    return f"(?:version |v ?|)?{major}" + (f"(?: {minor})?" if minor == "0" else f" {minor}")


def rules() -> list[tuple[str, str, str, str, str, int]]:
    """(anchor, keyword, left, right, label, priority) in order."""
    out = []
    for anchor in ("license", "licence"):
        for label, keyword, name, versions in FAMILIES:
            for grant, gain in ((_GRANT, 2), ("(?:the )?", 0)):
                for v in versions.split():
                    out.append((anchor, keyword, grant + name, _version(v) + _LATER, f"{label}-{v}-or-later", 3 + gain))
                    out.append((anchor, keyword, grant + name, _version(v), f"{label}-{v}", 2 + gain))
                out.append((anchor, keyword, grant + name, "", label, 1 + gain))
    for label, short, long in CREATIVE:
        for v in CREATIVE_VERSIONS:
            out.append(("cc", "by", "", f"by{short} {_version(v)}", f"{label}-{v}", 4))
            out.append(("commons", "creative", "creative", f"{long}(?: international| generic| license)? {_version(v)}",
                        f"{label}-{v}", 4))
        out.append(("cc", "by", "", f"by{short}", label, 2 + len(short.split())))
        out.append(("commons", "creative", "creative", long, label, 2))
    for label, _, _, versions in FAMILIES:
        for v in [*versions.split(), ""]:
            words = (f"{label} {v}").replace("-", " ").replace(".", " ").strip()
            tail = "(?: or later)" if label.endswith("gpl") else ""
            if tail:
                out.append(("spdx", "identifier", "", f"license identifier {words}{tail}", f"{label}-{v}-or-later".replace("--", "-"), 5))
            out.append(("spdx", "identifier", "", f"license identifier {words}(?: only)?", f"{label}-{v}".rstrip("-"), 4))
    out += [
        ("cc0", "cc0", "", "(?:1 0)?", "cc0", 3),
        ("commons", "zero", "creative", "zero(?: 1 0)?", "cc0", 3),
        ("domain", "public", "(?:released|placed|dedicated|put)(?: in)?(?: ?to)?(?: the)? public", "", "public-domain", 3),
        ("domain", "public", "public", "", "public-domain", 1),
        ("copyright", "copyright", "", "(?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})*", "copyright-notice", 1),
        ("unlicense", "unlicense", "", "", "unlicense", 2),
        ("wtfpl", "wtfpl", "", "(?:version )?2?", "wtfpl", 2),
        ("reserved", "rights", "(?:some|no) rights", "", "partly-reserved", 2),
    ]
    return out


ANCHORS = ("license", "licence", "cc", "commons", "spdx", "cc0", "domain", "copyright", "unlicense", "wtfpl", "reserved")
#: Each anchor contains one of these.
STEMS = ("licen", "cc", "commons", "spdx", "domain", "copyright", "wtfpl", "reserved")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def detections(counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(base places, detections): uid, label, start, stop (first and last word), priority."""
    spark = counted.sparkSession
    anchors = ", ".join(f"'{a}'" for a in ANCHORS)
    places = counted.where("words is not null").select("uid", "words", F.explode(F.expr(
        f"filter(sequence(0, size(words) - 1), i -> words[i] in ({anchors}))")).alias("at")).select(
        "uid", F.col("at").cast("long").alias("at"), F.expr("words[at]").alias("anchor"),
        F.expr(f"slice(words, greatest(at - {REACH}, 0) + 1, least(at, {REACH}))").alias("before"),
        F.expr(f"slice(words, at + 2, {REACH})").alias("after"))
    places = written(places, "anchors")
    left, right = F.array_join("before", " "), F.array_join("after", " ")
    places = places.withColumns({"left": left, "right": right})
    base = places.select("uid", F.expr("""
        case when anchor = 'cc' and get(after, 0) = 'by' then 'cc-by'
             when anchor = 'license' and left rlike '(^| )general public$' then 'gpl'
             when anchor = 'reserved' and left rlike '(^| )all rights$' then 'reserved' end""").alias("label"),
        F.when(F.col("anchor") == "cc", F.col("at")).otherwise(F.col("at") - 2).alias("start")).where("label is not null")
    # A table of fixed size, whatever the documents.
    table = F.broadcast(spark.createDataFrame(rules(), "anchor string, keyword string, l string, r string, label string, priority int"))
    near = places.withColumn("keyword", F.explode(F.expr("array_distinct(concat(before, array(anchor), after))")))
    hits = near.join(table, ["anchor", "keyword"]).where(
        "(l = '' or left rlike concat('(^| )(', l, ')$')) and (r = '' or right rlike concat('^(', r, ')( |$)'))")
    count = "if({x} = '', 0, length({x}) - length(replace({x}, ' ', '')) + 1)"
    hits = hits.withColumns({
        "lm": F.expr("if(l = '', '', regexp_extract(left, concat('(?:^| )(', l, ')$'), 1))"),
        "rm": F.expr("if(r = '', '', regexp_extract(right, concat('^(', r, ')(?: |$)'), 1))")})
    hits = hits.select("uid", "label", (F.col("at") - F.expr(count.format(x="lm"))).alias("start"),
                       (F.col("at") + F.expr(count.format(x="rm"))).alias("stop"), "priority")
    return base, hits.distinct()


def suppress(hits: DataFrame) -> DataFrame:
    """hits without those that lie within a stronger one. Neighbourhoods are 32 words, so joins stay small."""
    a = hits.withColumn("block", F.floor(F.col("start") / 32))
    b = hits.select("uid", *[F.col(c).alias(f"_{c}") for c in ("label", "start", "stop", "priority")]).withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("_start") / 32), F.floor(F.col("_stop") / 32))))
    inside = (F.col("_start") <= F.col("start")) & (F.col("_stop") >= F.col("stop"))
    size, other = F.col("stop") - F.col("start"), F.col("_stop") - F.col("_start")
    stronger = (F.col("_priority") > F.col("priority")) | ((F.col("_priority") == F.col("priority")) & (
        (other > size) | ((other == size) & (F.col("_label") < F.col("label")))))
    weak = a.join(b, ["uid", "block"]).where(inside & stronger).select("uid", "label", "start", "stop", "priority").distinct()
    return hits.join(weak, ["uid", "label", "start", "stop", "priority"], "left_anti")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, base places and labels, all labels, and the score of the strongest detection."""
    low = F.lower("text")
    gate = F.lit(False)
    for stem in STEMS:
        gate = gate | low.contains(stem)
    words = F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))
    counted = docs.select(
        F.monotonically_increasing_id().alias("uid"), "doc_id",
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")), F.lit(0)).cast("long").alias("n_words"),
        F.when(F.coalesce(gate, F.lit(False)), words).alias("words"))
    counted = written(counted, "words")
    base, hits = detections(counted)
    kept = suppress(written(hits, "detections"))
    confidence = F.create_map(*[x for k, v in CONFIDENCE.items() for x in (F.lit(k), F.lit(v))])
    marks = base.select("uid", "label", "start", F.lit(0).alias("priority"), F.lit(True).alias("base")).unionByName(
        kept.select("uid", "label", "start", "priority", F.lit(False).alias("base")))
    found = marks.groupBy("uid").agg(
        F.sum(F.col("base").cast("long")).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max(confidence[F.col("priority")]).alias("score"))
    return counted.drop("words").join(found, "uid", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir).select("doc_id", "text"))
