"""Entity tables derived from the given tables, for queries, benches and tests.

Every row of the tables goes in, of pages the title: every sentence of every document is a register entity, every
page title a client, every page title and every benchmark sentence an internal entity. A document
is a company group: its first sentence is the ultimate parent of all others.

Each view is one SELECT in the SQL that Spark and DuckDB share; the few spellings that differ are
filled in from ``_DIALECTS``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Rows of a table that a task takes at most: a document becomes many sentences, each of which is cleaned.
TASK_ROWS = 10_000

_DIALECTS = {
    "spark": {
        "sentences": r"lateral view posexplode(split({text}, r'[.\n]+')) s as pos, sentence",
        "sentence_rows": "{table} {lateral}",
        "text": "string",
        "div": "div",
        "title": "regexp_extract(html, r'<title>([^<]*)</title>', 1)",
        "page_lang": "regexp_extract(html, r'<html lang=\"([a-z]*)\"', 1)",
    },
    "duckdb": {
        "sentences": "",
        "sentence_rows": (
            "(select *, generate_subscripts(parts, 1) - 1 as pos, unnest(parts) as sentence from "
            r"(select *, regexp_split_to_array({text}, '[.\n]+') as parts from {table}))"
        ),
        "text": "varchar",
        "div": "//",
        "title": "regexp_extract(html, '<title>([^<]*)</title>', 1)",
        "page_lang": "regexp_extract(html, '<html lang=\"([a-z]*)\"', 1)",
    },
}

_VIEWS = {
    "fx_sentences": """
        select doc_id, cast(pos as bigint) as pos, trim(sentence) as sentence, upper(lang) as lang_u, source
        from {documents_by_sentence} where trim(sentence) <> ''
    """,
    "fx_entities": """
        select {lei_of_pos} as lei,
            sentence || case pos % 5 when 0 then ' Inc' when 1 then ' Ltd' when 2 then ' & Co'
                                     when 3 then ' Holdings GmbH' else '' end as legal_name,
            case when lang_u = 'EN' then 'GB' else lang_u end as country,
            case when pos % 4 <> 0 then 'R' || cast(doc_id as {text}) || '-' || cast(pos {div} 3 as {text}) end
                as registration_number,
            source || ' ' || lang_u as address
        from fx_sentences
    """,
    "fx_relationships": """
        select {lei_of_pos} as child_lei, {lei_of_tenth} as parent_lei,
            case when pos % 2 = 0 then 'IS_DIRECTLY_CONSOLIDATED_BY'
                 else ' is_directly_consolidated_by ' end as relationship_type,
            case when pos % 9 = 0 then 'INACTIVE' else 'ACTIVE' end as relationship_status,
            '201' || cast(pos % 10 as {text}) || '-01-15T00:00:00.000Z' as period_start
        from fx_sentences where pos > 0
        union all
        select {lei_of_pos}, {lei_of_first}, 'IS_ULTIMATELY_CONSOLIDATED_BY', 'ACTIVE', '2015-06-30'
        from fx_sentences where pos > 0
        union all
        select {lei_of_pos}, {lei_of_twentieth}, 'IS_DIRECTLY_CONSOLIDATED_BY', 'INACTIVE', '2009-12-31'
        from fx_sentences where lang_u = 'FR' and pos >= 20
    """,
    "fx_pages": """
        select page_id, {title} as title, upper({page_lang}) as lang_u from pages
    """,
    "fx_clients": """
        select 'C' || lpad(cast(page_id as {text}), 12, '0') as client_entity_id,
            case page_id % 3 when 0 then title when 1 then title || ' LIMITED' else title || ', Inc.' end
                as submitted_name,
            case when page_id % 4 = 1 then null when lang_u = 'EN' then 'gb ' else lang_u end as country,
            case when page_id % 6 = 0 then 'r' || cast(page_id as {text}) || '-1' end as registration_number,
            case when page_id % 5 = 3 then lower({lei_of_page}) end as lei,
            case when page_id % 5 = 0 then 'src' || cast(page_id % 10 as {text}) || ' ' || lang_u end as address
        from fx_pages
    """,
    "fx_internal": """
        select 'I' || lpad(cast(page_id as {text}), 12, '0') as internal_entity_id,
            case page_id % 5 when 0 then title || ' plc' when 1 then title || 's' when 2 then 'Old ' || title
                             when 3 then title || ' north' else 'New ' || title end as legal_name,
            case when lang_u = 'EN' then 'GB' else lang_u end as country, lang_u as address,
            case when page_id % 3 = 0 then {lei_of_page} end as lei,
            cast(null as {text}) as registration_number,
            case page_id % 3 when 0 then 'Low' when 1 then 'Medium' else 'High' end as internal_rating,
            lang_u as business_owner
        from fx_pages
        union all
        select 'B' || lpad(cast(item_id as {text}), 8, '0') || lpad(cast(pos as {text}), 4, '0'),
            trim(sentence), 'GB', '', null, null, 'Low', 'benchmark'
        from {benchmark_by_sentence} where trim(sentence) <> ''
    """,
    # Files as they arrive: repeats, rows without a key, padded and missing names, old headers.
    "fx_lei_file": """
        select lei, legal_name, country, registration_number,
            case when country = 'GB' then 'ACTIVE' else 'INACTIVE' end as entity_status,
            'House "' || address || '"' || chr(10) || 'Floor 2' as first_line, country as city
        from fx_entities
        union all
        select lei, legal_name, country, registration_number,
            case when country = 'GB' then 'ACTIVE' else 'INACTIVE' end,
            'House "' || address || '"' || chr(10) || 'Floor 2', country
        from fx_entities
        union all
        select null, legal_name, country, registration_number, null, address, null from fx_internal
    """,
    "fx_rr_file": """
        select child_lei, parent_lei, relationship_type, relationship_status, period_start,
            case when relationship_status = 'ACTIVE' then 'until further notice' else '2021-03-31' end as period_end
        from fx_relationships
        union all
        select child_lei, parent_lei, relationship_type, relationship_status, period_start,
            case when relationship_status = 'ACTIVE' then 'until further notice' else '2021-03-31' end
        from fx_relationships
        union all
        select child_lei, null, relationship_type, relationship_status, period_start, null from fx_relationships
    """,
    "fx_client_file": """
        select case page_no % 7 when 5 then null when 6 then '   ' else '  ' || submitted_name || ' ' end
                as client_name,
            country, registration_number, lei, address
        from (select *, cast(substring(client_entity_id, 2) as bigint) as page_no from fx_clients) numbered
        union all
        select submitted_name, country, registration_number, lei, address from fx_clients
    """,
}


def _lei(doc: str, pos: str, text: str) -> str:
    return f"'LEI' || lpad(cast({doc} as {text}), 11, '0') || lpad(cast({pos} as {text}), 6, '0')"


def view_sql(dialect: str) -> dict[str, str]:
    """SELECT text per view, in an order in which each only needs earlier ones."""
    words = _DIALECTS[dialect]
    text, div = words["text"], words["div"]

    def by_sentence(table: str, column: str) -> str:
        lateral = words["sentences"].format(text=column)
        return words["sentence_rows"].format(table=table, text=column, lateral=lateral)

    parts = {
        **{k: words[k] for k in ("text", "div", "title", "page_lang")},
        "documents_by_sentence": by_sentence("documents", "text"),
        "benchmark_by_sentence": by_sentence("benchmark", "text"),
        "lei_of_pos": _lei("doc_id", "pos", text),
        "lei_of_tenth": _lei("doc_id", f"pos {div} 10", text),
        "lei_of_twentieth": _lei("doc_id", f"pos {div} 20", text),
        "lei_of_first": _lei("doc_id", "0", text),
        "lei_of_page": _lei("page_id", "2", text),
    }
    return {name: sql.format(**parts) for name, sql in _VIEWS.items()}


def _scan(spark: SparkSession, path: str) -> DataFrame:
    """The table; one of few files for its rows, which few tasks would read, is spread over all cores or more tasks first."""
    table, cores = spark.read.parquet(path), spark.sparkContext.defaultParallelism
    tasks = max(cores, -(-table.count() // TASK_ROWS))
    return table.repartition(tasks) if len(table.inputFiles()) < tasks else table


def views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every view as a DataFrame over the parquet files in ``sf_dir``."""
    frames = {t: _scan(spark, f"{sf_dir}/{t}.parquet") for t in ("documents", "pages", "benchmark")}
    for name, sql in view_sql("spark").items():
        inputs = {t: df for t, df in frames.items() if f"from {t} " in f"{sql} ".replace("\n", " ")}
        for table in inputs:
            sql = re.sub(rf"\bfrom {table}\b", f"from {{{table}}}", sql)
        frames[name] = spark.sql(sql, **inputs)
    return frames
