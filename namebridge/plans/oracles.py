"""DuckDB form of the queries, written the plain way: OR joins, row-level unions, full windows."""

from __future__ import annotations

import re

from namebridge.functions.ids import ID_HEX_DIGITS
from namebridge.functions.text import LEGAL_WORD_PATTERN
from namebridge.plans.fixtures import view_sql


def _clean(name: str, strip_legal: bool = True) -> str:
    words = rf"regexp_replace(replace(lower({name}), '&', ' and '), '[^a-z0-9\s]', ' ', 'g')"
    if strip_legal:
        words = f"regexp_replace({words}, '{LEGAL_WORD_PATTERN}', ' ', 'g')"
    return rf"trim(regexp_replace({words}, '\s+', ' ', 'g'))"


def _normalised(source: str, name: str, columns: str) -> str:
    return f"""
        select *, split_part(clean_name, ' ', 1) as first_token, substring(clean_name, 1, 4) as name_prefix_4,
            concat_ws('|', country_norm, substring(clean_name, 1, 4)) as blocking_key
        from (select {columns}, {_clean(name)} as clean_name, upper(trim(country)) as country_norm,
                upper(trim(registration_number)) as registration_number_norm, upper(trim(lei)) as lei_norm,
                lower(trim(address)) as address_norm
              from {source}) keyed
    """


_CANDIDATE_COLUMNS = """
    c.client_entity_id, c.submitted_name, c.clean_name as client_clean_name, c.country_norm as client_country,
    c.registration_number_norm as client_registration_number, c.lei_norm as client_lei,
    c.address_norm as client_address, r.reference_id, r.legal_name as candidate_name,
    r.clean_name as candidate_clean_name, r.country_norm as candidate_country,
    r.registration_number_norm as candidate_registration_number, r.lei_norm as candidate_lei,
    r.address_norm as candidate_address, r.source as candidate_source
"""
_NAME_BLOCK = "(c.first_token = r.first_token or c.name_prefix_4 = r.name_prefix_4)"


def _candidates(method: str, condition: str) -> str:
    return f"""
        select {_CANDIDATE_COLUMNS}, '{method}' as candidate_method
        from clients c join reference r on {condition}
    """


def _jaccard(left: str, right: str) -> str:
    shared = f"len(list_intersect({left}, {right}))"
    return (
        f"case when len({left}) > 0 and len({right}) > 0 "
        f"then {shared} / (len({left}) + len({right}) - {shared}) else 0e0 end"
    )


def _tokens(text: str) -> str:
    return rf"list_distinct(regexp_extract_all({text}, '\S+'))"


def _similarity(left: str, right: str) -> str:
    return f"1e0 - levenshtein({left}, {right}) / greatest(length({left}), length({right}))"


def _round4(value: str) -> str:
    """Half up on the shortest decimal form of the double, as Spark rounds."""
    return f"cast(round(cast(cast({value} as varchar) as decimal(30, 20)), 4) as double)"


_BY_REGISTRATION = "0.80e0 + 0.10e0 * similarity + 0.10e0 * country_score"
_BY_NAME = """least(0.60e0 * similarity + 0.20e0 * token_overlap + 0.15e0 * country_score + 0.05e0 * address_score
    + case when candidate_method = 'NAME_COUNTRY_BLOCK' then 0.03e0 else 0e0 end, 0.98e0)"""

#: The matching-blocks ratio: runs of equal characters on a diagonal of a pair of names; then, piece by
#: piece, the longest run within the piece (the first of several), and the pieces left and right of it.
_RATIO = {
    "name_pairs": """
        select row_number() over () as id, a, b from (
            select distinct client_clean_name as a, candidate_clean_name as b from candidates
            where client_clean_name <> '' and candidate_clean_name <> '') named
    """,
    "equal_cells": """
        select l.id, l.i, r.j from
            (select id, i, substring(a, i + 1, 1) as c
             from (select id, a, unnest(range(length(a))) as i from name_pairs) x) l
            join (select id, j, substring(b, j + 1, 1) as c
                  from (select id, b, unnest(range(length(b))) as j from name_pairs) y) r
            on l.id = r.id and l.c = r.c
    """,
    "diagonal_runs": """
        select id, min(i) as i0, min(j) as j0, count(*) as n
        from (select *, i - row_number() over (partition by id, i - j order by i) as gap from equal_cells) numbered
        group by id, i - j, gap
    """,
    "pieces": """
        select id, 0::bigint as alo, length(a)::bigint as ahi, 0::bigint as blo, length(b)::bigint as bhi,
            0::bigint as got
        from name_pairs
        union all
        select id, case when side = 0 then alo else bi + size end, case when side = 0 then bi else ahi end,
            case when side = 0 then blo else bj + size end, case when side = 0 then bj else bhi end,
            case when side = 0 then size else 0 end
        from (
            select id, alo, ahi, blo, bhi, (best).s as size, -(best).i as bi, -(best).j as bj
            from (
                select id, alo, ahi, blo, bhi, max({'s': stop - start, 'i': -(i0 + start), 'j': -(j0 + start)}) as best
                from (
                    select p.id, alo, ahi, blo, bhi, i0, j0, greatest(0, alo - i0, blo - j0) as start,
                        least(n, ahi - i0, bhi - j0) as stop
                    from pieces p join diagonal_runs r on p.id = r.id where ahi > alo and bhi > blo) clipped
                where stop > start group by id, alo, ahi, blo, bhi) longest) found
            cross join (values (0), (1)) sides(side)
    """,
    "ratios": """
        select a, b, 2e0 * matched / (length(a) + length(b)) as ratio
        from (select id, sum(got) as matched from pieces group by id) counted join name_pairs using (id)
    """,
}
#: Steps that refer to themselves.
_RECURSIVE = ("pieces",)

_EVIDENCE = f"""
    select *,
        coalesce(client_lei <> '' and client_lei = candidate_lei, false) as same_lei,
        coalesce(client_registration_number <> '' and client_registration_number = candidate_registration_number,
            false) as same_registration,
        case when coalesce(client_clean_name, '') = '' or coalesce(candidate_clean_name, '') = '' then 0e0
             else {_similarity("client_clean_name", "candidate_clean_name")} end as similarity,
        {_jaccard("client_tokens", "candidate_tokens")} as token_overlap,
        case when coalesce(client_country, '') = '' then 0.5e0 when coalesce(candidate_country, '') = '' then 0.3e0
             when client_country = candidate_country then 1e0 else 0e0 end as country_score,
        case when coalesce(client_address, '') = '' then 0.5e0
             when len(client_address_tokens) > 0 and len(candidate_address_tokens) > 0
             then {_jaccard("client_address_tokens", "candidate_address_tokens")} else 0.3e0 end as address_score
    from (select *, {_tokens("client_clean_name")} as client_tokens,
            {_tokens("candidate_clean_name")} as candidate_tokens,
            {_tokens("client_address")} as client_address_tokens,
            {_tokens("candidate_address")} as candidate_address_tokens
          from candidates) tokens
"""

_SCORED = f"""
    select *,
        case when match_score >= 0.90e0 then 'AUTO_MATCH' when match_score >= 0.75e0 then 'REVIEW'
             else 'LOW_CONFIDENCE' end as confidence_band,
        concat_ws('; ', 'candidate_method=' || candidate_method, case when same_lei then 'exact_lei_match' end,
            case when same_registration then 'registration_number_match' end,
            case when coalesce(client_country, '') = '' or coalesce(candidate_country, '') = ''
                 then 'country_not_provided_or_missing'
                 when client_country = candidate_country then 'country_match=True'
                 else 'country_match=False' end) as match_reason,
        client_country is not null and client_country = candidate_country as country_match
    from (
        select *, case when same_lei then 0.99e0
            when same_registration then {_round4(_BY_REGISTRATION)} else {_round4(_BY_NAME)} end as match_score
        from evidence) rated
"""

_RANKED = """
    select *, row_number() over (partition by client_entity_id order by match_score desc,
        case candidate_method when 'EXACT_LEI' then 1 when 'REGISTRATION_NUMBER' then 2
            when 'NAME_COUNTRY_BLOCK' then 3 else 4 end, reference_id) as candidate_rank
    from scored
"""

_MATCHES = """
    select 'run_001' as run_id, client_entity_id, submitted_name, reference_id as matched_reference_id,
        candidate_lei as matched_lei, candidate_name as matched_name, candidate_source as matched_source,
        candidate_method, match_score, confidence_band, match_reason, country_match
    from ranked where candidate_rank = 1
"""


def _parent_edges(role: str, edges: str) -> str:
    kind = {"direct": "IS_DIRECTLY_CONSOLIDATED_BY", "ultimate": "IS_ULTIMATELY_CONSOLIDATED_BY"}[role]
    return f"""
        select upper(trim(child_lei)) as child, parent_lei, relationship_status, period_start, period_end
        from {edges} where upper(trim(relationship_type)) = '{kind}' and parent_lei is not null
    """


def _hierarchy(edges: str) -> str:
    joins, columns = "", ""
    for role, short in (("direct", "d"), ("ultimate", "u")):
        joins += f"""
            left join ({_parent_edges(role, edges)}) {short} on m.matched_lei = {short}.child
            left join fx_entities {short}n on {short}.parent_lei = {short}n.lei
        """
        columns += f"""
            {short}.parent_lei as {role}_parent_lei, {short}n.legal_name as {role}_parent_name,
            {short}.relationship_status as {role}_relationship_status, {short}.period_start as {role}_period_start,
            {short}.period_end as {role}_period_end,
        """
    return f"""
        select m.run_id, m.client_entity_id, m.submitted_name, m.matched_lei, m.matched_name, m.matched_source,
            m.candidate_method, {columns} m.match_score, m.confidence_band, m.match_reason
        from matches m {joins}
    """


_ROLES = ("submitted", "matched", "direct_parent", "ultimate_parent")


def _role_keys() -> str:
    leis = [f"nullif(upper(trim({r}_lei)), '') as {r}_lei_norm" for r in _ROLES[1:]]
    names = [f"{_clean(f'''coalesce({r}_name, '')''')} as {r}_clean_name" for r in _ROLES]
    blocks = [
        f"split_part({r}_clean_name, ' ', 1) as {r}_first_token, substring({r}_clean_name, 1, 4) as {r}_prefix_4"
        for r in _ROLES
    ]
    return f"select *, {', '.join(blocks)} from (select *, {', '.join(leis + names)} from hierarchy) cleaned"


_INTERNAL = """
    select internal_entity_id, legal_name as internal_client_name, lei as internal_client_lei, internal_rating,
        business_owner, nullif(upper(trim(lei)), '') as internal_lei_norm, clean_name as internal_clean_name,
        first_token as internal_first_token, name_prefix_4 as internal_prefix_4
    from internal
"""

# Type, priority and score or threshold per role.
_LADDERS = {
    "lei": {
        "matched": ("DIRECT_LEI", 1, 1.0), "direct_parent": ("DIRECT_PARENT_LEI", 2, 1.0),
        "ultimate_parent": ("ULTIMATE_PARENT_LEI", 3, 1.0),
    },
    "name": {
        "submitted": ("SUBMITTED_NORMALIZED_NAME", 4, 0.94), "matched": ("GLEIF_NORMALIZED_NAME", 5, 0.92),
        "direct_parent": ("DIRECT_PARENT_NORMALIZED_NAME", 6, 0.90),
        "ultimate_parent": ("ULTIMATE_PARENT_NORMALIZED_NAME", 7, 0.88),
    },
    "fuzzy": {
        "submitted": ("SUBMITTED_FUZZY_NAME", 8, 0.78), "matched": ("GLEIF_FUZZY_NAME", 9, 0.82),
        "direct_parent": ("DIRECT_PARENT_FUZZY_NAME", 10, 0.82),
        "ultimate_parent": ("ULTIMATE_PARENT_FUZZY_NAME", 11, 0.82),
    },
}
_MAPPING_COLUMNS = """
    client_entity_id, direct_parent_lei, ultimate_parent_lei, match_score, internal_entity_id, internal_client_name,
    internal_client_lei, internal_rating, business_owner, internal_mapping_type, mapping_priority,
    internal_mapping_score
"""


def _mappings(kind: str, keys: str = "role_keys") -> str:
    branches = []
    for role, (label, priority, value) in _LADDERS[kind].items():
        name = f"h.{role}_clean_name"
        score = f"{value}e0"
        if kind == "lei":
            condition = f"h.{role}_lei_norm = i.internal_lei_norm"
        elif kind == "name":
            condition = f"{name} <> '' and {name} = i.internal_clean_name"
        else:
            similarity = _similarity(name, "i.internal_clean_name")
            condition = (
                f"{name} <> '' and i.internal_clean_name <> '' and (h.{role}_first_token = i.internal_first_token "
                f"or h.{role}_prefix_4 = i.internal_prefix_4) and {similarity} >= {value}e0"
            )
            score = _round4(similarity)
        branches.append(
            f"select h.*, i.*, '{label}_MATCH_TO_INTERNAL_CLIENT' as internal_mapping_type, "
            f"{priority} as mapping_priority, {score} as internal_mapping_score "
            f"from {keys} h join internal_side i on {condition}"
        )
    return " union all ".join(branches)


_BEST = """
    select * exclude (rn) from (
        select *, row_number() over (partition by client_entity_id order by mapping_priority,
            internal_mapping_score desc, match_score desc, internal_entity_id nulls first,
            internal_client_name nulls first, internal_client_lei nulls first, internal_rating nulls first,
            business_owner nulls first, direct_parent_lei nulls first, ultimate_parent_lei nulls first) as rn
        from (select * from lei_mappings union all select * from name_mappings
              union all select * from fuzzy_mappings) every_mapping) numbered
    where rn = 1
"""

_UNMAPPED = """
    select * exclude (rn) from (
        select *, row_number() over (partition by client_entity_id order by match_score desc,
            direct_parent_lei nulls first, ultimate_parent_lei nulls first, direct_relationship_status nulls first,
            ultimate_relationship_status nulls first) as rn
        from role_keys where client_entity_id not in (select client_entity_id from best)) numbered
    where rn = 1
"""


def _gold(source: str, mapped: bool) -> str:
    details = (
        "internal_entity_id as internal_client_entity_id, internal_client_name, internal_client_lei, "
        "internal_rating, business_owner, match_score, confidence_band, match_reason, internal_mapping_type, "
        "mapping_priority, internal_mapping_score"
        if mapped
        else "null, null, null, null, null, match_score, confidence_band, match_reason, "
        "'NO_INTERNAL_CLIENT_MATCH', 99, null"
    )
    return f"""
        select run_id, client_entity_id, submitted_name, matched_lei as matched_gleif_lei,
            matched_name as matched_gleif_name, matched_source, candidate_method, direct_parent_lei,
            direct_parent_name, direct_relationship_status, ultimate_parent_lei, ultimate_parent_name,
            ultimate_relationship_status, {details}
        from {source}
    """


_UNSTRIPPED_KEYS = "select *, " + ", ".join(
    f"{_clean(f'''coalesce({r}_name, '')''', strip_legal=False)} as {r}_clean_name" for r in _ROLES
) + " from hierarchy"

#: Named subqueries; each uses earlier ones only.
_STEPS = {
    **view_sql("duckdb"),
    "clients": _normalised(
        "fx_clients", "submitted_name",
        "client_entity_id, submitted_name, country, registration_number, lei, address",
    ),
    "reference": _normalised(
        "fx_entities", "legal_name",
        "lei as reference_id, legal_name, country, address, lei, registration_number, 'GLEIF' as source",
    ),
    "internal": _normalised("fx_internal", "legal_name", "*"),
    "edges": """
        select child_lei, parent_lei, relationship_type, relationship_status,
            cast(substring(period_start, 1, 10) as date) as period_start, cast(null as date) as period_end
        from fx_relationships
    """,
    "latest_edges": """
        select * exclude (rn) from (
            select *, row_number() over (partition by child_lei, upper(trim(relationship_type))
                order by period_start desc nulls last, parent_lei) as rn
            from edges where upper(trim(relationship_status)) = 'ACTIVE') numbered
        where rn = 1
    """,
    "lei_candidates": _candidates("EXACT_LEI", "c.lei_norm <> '' and c.lei_norm = r.lei_norm"),
    "registration_candidates": _candidates(
        "REGISTRATION_NUMBER",
        "c.registration_number_norm <> '' and c.registration_number_norm = r.registration_number_norm",
    ),
    "name_country_candidates": _candidates(
        "NAME_COUNTRY_BLOCK",
        f"c.country_norm <> '' and c.clean_name <> '' and c.country_norm = r.country_norm and {_NAME_BLOCK}",
    ),
    "name_only_candidates": _candidates("NAME_ONLY_BLOCK", f"c.clean_name <> '' and {_NAME_BLOCK}"),
    "empty_block_candidates": _candidates("NAME_ONLY_BLOCK", _NAME_BLOCK),
    "candidates": """
        select * from lei_candidates union all select * from registration_candidates
        union all select * from name_country_candidates union all select * from name_only_candidates
    """,
    **_RATIO,
    "evidence": _EVIDENCE,
    "scored": _SCORED,
    "ranked": _RANKED,
    "matches": _MATCHES,
    "hierarchy": _hierarchy("edges"),
    "hierarchy_latest": _hierarchy("latest_edges"),
    "role_keys": _role_keys(),
    "unstripped_keys": _UNSTRIPPED_KEYS,
    "internal_side": _INTERNAL,
    "lei_mappings": _mappings("lei"),
    "name_mappings": _mappings("name"),
    "unstripped_name_mappings": _mappings("name", "unstripped_keys"),
    "fuzzy_mappings": _mappings("fuzzy"),
    "best": _BEST,
    "unmapped": _UNMAPPED,
    "ingested_clients": """
        select distinct trim(client_name) as submitted_name, trim(country) as country,
            trim(registration_number) as registration_number, trim(lei) as lei, trim(address) as address
        from fx_client_file where trim(client_name) <> ''
    """,
}

_RATIO_EVIDENCE = f"""
    select e.* replace (coalesce(r.ratio, 0e0) as similarity)
    from ({_EVIDENCE}) e left join ratios r on e.client_clean_name = r.a and e.candidate_clean_name = r.b
"""


def _chain(suffix: str, first: str, changed: dict[str, str]) -> None:
    """Adds copies of the steps from ``first`` to ``unmapped``, some changed, that refer to each other."""
    names = list(_STEPS)
    names = [n for n in names[names.index(first) : names.index("unmapped") + 1] if n in changed or n in _RATIO or n in _FLOW]
    for name in names:
        sql = changed.get(name, _STEPS[name])
        _STEPS[name + suffix] = re.sub(
            r"\b(from|join)\s+(\w+)\b", lambda m: f"{m[1]} {m[2]}{suffix}" if m[2] in names else m[0], sql)


#: Steps through which rows flow from the clients to the gold table.
_FLOW = (
    "clients", "lei_candidates", "registration_candidates", "name_country_candidates", "name_only_candidates",
    "candidates", "evidence", "scored", "ranked", "matches", "hierarchy", "role_keys", "lei_mappings", "name_mappings",
    "fuzzy_mappings", "best", "unmapped",
)
_KEY = "client_entity_id, reference_id, candidate_method"
_ID_FIELDS = ("submitted_name", "country", "registration_number", "lei", "address")
_CLIENT_ID = "'C' || substring(sha256(" + " || ".join(
    f"coalesce(cast(length({c}) as varchar) || ':' || {c}, '-')" for c in _ID_FIELDS
) + f"), 1, {ID_HEX_DIGITS})"

def _queue(ranked: str) -> str:
    return f"""
        select 'run_001' as run_id, client_entity_id, submitted_name, candidate_rank,
            reference_id as matched_reference_id, candidate_lei as matched_lei, candidate_name as matched_name,
            candidate_source as matched_source, candidate_method, match_score, match_reason,
            'PENDING' as review_status, cast(null as varchar) as reviewer, cast(null as varchar) as review_comment
        from {ranked} where candidate_rank <= 5
    """


#: Columns of the four exported tables, in the order in which the files have them.
_EXPORTED = {
    "gold_mapping": ("client_entity_id", "matched_gleif_lei", "direct_parent_lei", "ultimate_parent_lei",
                     "internal_client_entity_id", "internal_client_name", "internal_mapping_type", "confidence_band",
                     "match_reason"),
    "review_queue": ("client_entity_id", "candidate_rank", "matched_reference_id", "matched_lei", "matched_name",
                     "candidate_method", "match_reason", "review_status", "reviewer"),
    "match_results": ("client_entity_id", "matched_reference_id", "matched_lei", "matched_name", "candidate_method",
                      "confidence_band", "match_reason", "country_match"),
    "entity_hierarchy": ("client_entity_id", "matched_lei", "direct_parent_lei", "direct_parent_name",
                         "direct_relationship_status", "direct_period_start", "ultimate_parent_lei",
                         "ultimate_parent_name", "match_reason"),
}


def exported_columns(table: str) -> tuple[str, ...]:
    """Columns without scores, which files round on their own terms."""
    return _EXPORTED[table]


def _exported(table: str, source: str) -> str:
    columns = ", ".join(f"coalesce(cast({c} as varchar), '-')" for c in _EXPORTED[table])
    return f"select '{table}' as table_name, concat_ws('|', {columns}) as row_text from {source}"


_STEPS["upload_ids"] = f"select {_CLIENT_ID} as client_entity_id, * from ingested_clients"
#: The default path, with the matching-blocks ratio; and the same from the uploaded file on.
_chain("_seq", "evidence", {"evidence": _RATIO_EVIDENCE})
_chain("_file", "clients", {"evidence": _RATIO_EVIDENCE, "clients": _normalised(
    "upload_ids", "submitted_name", "client_entity_id, submitted_name, country, registration_number, lei, address")})

#: Clients of files in three shapes: all columns, names alone, and some columns in another order. A line of a file
#: of names that holds none, or blanks alone, is an empty line, which is no row of the file.
_STEPS["arrived_rows"] = """
    select client_name, country, registration_number, lei, address from fx_client_file where country is not null
    union all select client_name, null, null, null, null from fx_client_file where trim(client_name) <> ''
    union all select client_name, null, null, lei, address from fx_client_file
    union all select client_name, country, registration_number, lei, address from fx_client_file
        where country is not null
"""
_STEPS["arrived"] = f"""
    select {_CLIENT_ID} as client_entity_id, * from (
        select distinct trim(client_name) as submitted_name, trim(country) as country,
            trim(registration_number) as registration_number, trim(lei) as lei, trim(address) as address
        from arrived_rows where trim(client_name) <> '') fields
"""
_chain("_arrived", "clients", {"clients": _normalised(
    "arrived", "submitted_name", "client_entity_id, submitted_name, country, registration_number, lei, address")})

_STEPS["gold_lev"] = f"{_gold('best', True)} union all {_gold('unmapped', False)}"
_STEPS["queue_lev"] = _queue("ranked")

_SCORE_COLUMNS = f"{_KEY}, match_score, confidence_band, match_reason, country_match"


_FINAL = {
    "name_ratio": """
        select l.clean_name as client_clean_name, r.clean_name as candidate_clean_name, ratio as name_ratio
        from (select distinct clean_name from clients) l join (select distinct clean_name from reference) r
            on l.clean_name <> '' and (split_part(l.clean_name, ' ', 1) = split_part(r.clean_name, ' ', 1)
                or substring(l.clean_name, 1, 4) = substring(r.clean_name, 1, 4))
            join ratios on l.clean_name = a and r.clean_name = b
    """,
    "score_candidates": f"select {_SCORE_COLUMNS} from scored_seq",
    "ranked_candidates": f"select {_KEY}, match_score, candidate_rank from ranked_seq",
    "match_results": "select * from matches_seq",
    "review_queue": _queue("ranked_seq"),
    "gold_mapping": f"{_gold('best_seq', True)} union all {_gold('unmapped_seq', False)}",
    "incremental_matches": f"""
        select * exclude (run_id, client_entity_id)
        from ({_gold('best_file', True)} union all {_gold('unmapped_file', False)}) gold
    """,
    "arrivals_gold": f"""
        select * exclude (run_id)
        from ({_gold('best_arrived', True)} union all {_gold('unmapped_arrived', False)}) gold
    """,
    "arrivals_matches": "select * exclude (run_id) from matches_arrived",
    "arrivals_review_queue": f"select * exclude (run_id) from ({_queue('ranked_arrived')}) queue",
    "arrivals_rejected_rows": """
        select *, case when client_name is null then 'missing_client_name' else 'blank_client_name' end
            as reject_reason
        from arrived_rows where client_name is null or trim(client_name) = ''
    """,
    "arrivals_rejected_files": """
        select 'company,country' as headers, 'no_client_name_column' as reject_reason, count(*) as n_rows
        from fx_client_file
    """,
    "clean_names": f"""
        select lei, {_clean("legal_name")} as clean_name,
            {_clean("coalesce(legal_name, '')", strip_legal=False)} as unstripped_name
        from fx_entities
    """,
    "normalise_keys": """
        select client_entity_id, country_norm, registration_number_norm, lei_norm, address_norm from clients
    """,
    "block_keys": """
        select lei, first_token, substring(clean_name, 1, 6) as name_prefix_6,
            concat_ws('|', country_norm, substring(clean_name, 1, 6)) as blocking_key, name_prefix_4
        from reference
    """,
    "normalise_headers": """
        select client_entity_id as client_id, submitted_name as client_name, country,
            registration_number as lei, lei as lei_2, address as unnamed
        from fx_clients
    """,
    "surrogate_ids": f"""
        select count(*) as n, count(distinct id) as n_distinct, min(id) as least, max(id) as greatest
        from (select {_CLIENT_ID} as id from ingested_clients) ids
    """,
    "ingest_register_csv": "select * replace (nullif(first_line, '') as first_line) from fx_lei_file",
    "ingest_client_csv": "select * from ingested_clients",
    "ingest_name_only_csv": """
        select distinct trim(client_name) as submitted_name, cast(null as varchar) as country,
            cast(null as varchar) as registration_number, cast(null as varchar) as lei,
            cast(null as varchar) as address
        from fx_client_file where trim(client_name) <> ''
    """,
    "ingest_internal_csv": """
        select internal_entity_id, trim(legal_name) as legal_name, country, nullif(address, '') as address, lei,
            registration_number, internal_rating, business_owner
        from fx_internal
    """,
    "rejected_rows": """
        select *, case when client_name is null then 'missing_client_name' else 'blank_client_name' end
            as reject_reason
        from fx_client_file where client_name is null or trim(client_name) = ''
    """,
    "silver_entities": """
        select distinct lei, legal_name, cast(null as varchar) as legal_name_language, country,
            cast(null as varchar) as hq_country, cast(null as varchar) as legal_jurisdiction,
            cast(null as varchar) as registration_authority_id, registration_number,
            cast(null as varchar) as legal_form, entity_status, cast(null as varchar) as registration_status,
            concat_ws(' ', first_line, city, country) as legal_address
        from fx_lei_file where lei is not null
    """,
    "silver_relationships": """
        select child_lei, parent_lei, relationship_type, relationship_status,
            cast(substring(period_start, 1, 10) as date) as period_start, try_cast(period_end as date) as period_end
        from (select *, row_number() over (partition by child_lei, parent_lei, relationship_type
                  order by relationship_status, cast(substring(period_start, 1, 10) as date),
                      try_cast(period_end as date) nulls first) as rn
              from fx_rr_file where child_lei is not null and parent_lei is not null) numbered
        where rn = 1
    """,
    "clean_reference": """
        select reference_id, legal_name, source, clean_name, country_norm, registration_number_norm, lei_norm,
            address_norm, first_token, name_prefix_4, blocking_key
        from reference
    """,
    "candidates_lei": "select * from lei_candidates",
    "candidates_registration": "select * from registration_candidates",
    "candidates_name_country": "select * from name_country_candidates",
    "candidates_name_only": "select * from name_only_candidates",
    "candidates_empty_block": "select * from empty_block_candidates",
    "candidates_all": "select * from candidates",
    "candidate_preview": f"select * from candidates order by {_KEY} limit 100",
    "token_overlap": f"select {_KEY}, token_overlap from evidence",
    "field_scores": f"select {_KEY}, country_score, address_score from evidence",
    "match_reasons": f"select {_KEY}, match_reason, country_match from scored",
    "confidence_bands": "select candidate_method, confidence_band, count(*) as n from scored group by all",
    "score_candidates_lev": f"select {_KEY}, match_score, confidence_band, match_reason, country_match from scored",
    "ranked_candidates_lev": f"select {_KEY}, match_score, candidate_rank from ranked",
    "match_results_lev": "select * from matches",
    "unmatched_kept_lev": """
        select * from matches
        union all
        select 'run_001', client_entity_id, submitted_name, null, null, null, null, null, null, 'NO_MATCH', null, null
        from clients where client_entity_id not in (select client_entity_id from matches)
    """,
    "review_queue_lev": _queue("ranked"),
    "hierarchy_enrich": "select * from hierarchy",
    "hierarchy_active_only": "select * from hierarchy_latest",
    "gold_name_keys": f"""
        select client_entity_id, direct_parent_lei, ultimate_parent_lei,
            {", ".join(f"{r}_lei_norm" for r in _ROLES[1:])},
            {", ".join(f"{r}_clean_name, {r}_first_token, {r}_prefix_4" for r in _ROLES)}
        from role_keys
    """,
    "gold_lei_mapping": f"select {_MAPPING_COLUMNS} from lei_mappings",
    "gold_name_mapping": f"select {_MAPPING_COLUMNS} from name_mappings",
    "gold_name_mapping_unstripped": f"select {_MAPPING_COLUMNS} from unstripped_name_mappings",
    "gold_fuzzy_mapping": f"select {_MAPPING_COLUMNS} from fuzzy_mappings",
    "gold_no_match": """
        select client_entity_id, submitted_name, direct_parent_lei, ultimate_parent_lei from unmapped
    """,
    "gold_mapping_lev": f"{_gold('best', True)} union all {_gold('unmapped', False)}",
    "export_review_bundle": " union all ".join([
        _exported("gold_mapping", "gold_lev"), _exported("review_queue", "queue_lev"),
        _exported("match_results", "matches"), _exported("entity_hierarchy", "hierarchy"),
    ]),
}


def _with_steps(final: str) -> str:
    """The query with the steps it needs, directly or through others, as CTEs."""
    needed: set[str] = set()
    pending = [final]
    while pending:
        sql = pending.pop()
        for name, step in _STEPS.items():
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", sql):
                needed.add(name)
                pending.append(step)
    ctes = [
        f"{name} as {'' if name.startswith(_RECURSIVE) else 'materialized '}({_STEPS[name]})"
        for name in _STEPS if name in needed
    ]
    recursive = "recursive " if any(name.startswith(_RECURSIVE) for name in needed) else ""
    return f"with {recursive}{', '.join(ctes)} {final}"


def oracle_sql() -> dict[str, str]:
    return {name: _with_steps(final) for name, final in _FINAL.items()}
