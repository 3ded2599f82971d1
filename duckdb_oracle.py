"""Oracle SQL (DuckDB dialect) for the registered queries.

Each query is written independently of the Spark code path: blocking as one
OR self-join, Jaro-Winkler by DuckDB's own function, connected components by
a recursive reachability CTE, ids by ``row_number``. The views
``part orders customer pages`` are the driver's tables.
"""

from __future__ import annotations

import math

from fixture_views import (ENTITY_SQL, FIXED_LEVELS, HISTORY_SQL, archive_lines_sql, customer_lines_sql, listing_sql,
                           loaded_sql, present_sql)
from linkforge.functions.text import LEGAL_SUFFIX_PATTERN, MONTHS
from linkforge.operators.explore import SIZE_BAND_ELSE, SIZE_BANDS
from linkforge.operators.scoring import WEIGHT_BAND_ELSE, WEIGHT_BANDS
from linkforge.schema import REGISTRATION_COLUMNS, SOURCE_POSITIONS
from linkforge.settings import (DEFAULT_COMPARISONS, DEFAULT_EM_CONVERGENCE, DEFAULT_MAX_ITERATIONS,
                                DEFAULT_TRAINING_BLOCKS, DEFAULT_U_MAX_PAIRS)

PRIOR = 1e-4
SMALL_U_SAMPLE = 5_000
SMALL_BLOCK_ROWS = 3


def normalizer(col: str) -> str:
    return (f"nullif(trim(regexp_replace(regexp_replace(trim(lower({col})), '{LEGAL_SUFFIX_PATTERN}', '', 'g'), "
            f"'\\s+', ' ', 'g')), '')")


def _lit(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _gamma_sql(comp, alias: str = "") -> str:
    c = comp.column
    l, r = f"{alias}{c}_l", f"{alias}{c}_r"
    parts = [f"WHEN {l} IS NULL OR {r} IS NULL THEN -1", f"WHEN {l} = {r} THEN {comp.exact_level}"]
    if comp.kind == "jaro_winkler":
        for level, t in zip(range(comp.exact_level - 1, 0, -1), comp.thresholds):
            parts.append(f"WHEN jaro_winkler_similarity({l}, {r}) >= {t} THEN {level}")
    return f"CASE {' '.join(parts)} ELSE 0 END"


def _bf_sql(comp) -> str:
    levels = FIXED_LEVELS[comp.column]
    parts = [f"WHEN gamma_{comp.column} = {g} THEN {_lit(math.log2(m / u))}"
             for g, (m, u) in sorted(levels.items(), reverse=True)]
    return f"CASE {' '.join(parts)} ELSE CAST(0 AS DOUBLE) END"


def _tf_sql(comp) -> str:
    u_exact = FIXED_LEVELS[comp.column][comp.exact_level][1]
    tf = f"greatest(tf_{comp.column}_l, tf_{comp.column}_r)"
    return (f"CASE WHEN gamma_{comp.column} = {comp.exact_level} AND {tf} IS NOT NULL "
            f"THEN log2({_lit(u_exact)} / {tf}) ELSE CAST(0 AS DOUBLE) END")


COLS = ["uei", "legal_name", "name_norm", "name_first4", "dba_name", "phys_city", "zip5", "phys_state",
        "entity_url", "primary_naics", "gov_poc_last", "cage_code", "entity_structure"]
TF_COLS = [c.column for c in DEFAULT_COMPARISONS if c.tf_adjust]


def base_ctes() -> str:
    e = ENTITY_SQL.replace("{part}", "part")
    tf_ctes = ",\n".join(
        f"tf_{c} AS (SELECT {c} AS v, CAST(count(*) AS DOUBLE) / (SELECT count({c}) FROM li) AS tf "
        f"FROM li WHERE {c} IS NOT NULL GROUP BY {c})" for c in TF_COLS)
    rec_tf = ", ".join(f"tf_{c}.tf AS tf_{c}" for c in TF_COLS)
    rec_join = " ".join(f"LEFT JOIN tf_{c} ON tf_{c}.v = li.{c}" for c in TF_COLS)
    sel = ", ".join([f"l.{c} AS {c}_l" for c in COLS + [f"tf_{t}" for t in TF_COLS]]
                    + [f"r.{c} AS {c}_r" for c in COLS + [f"tf_{t}" for t in TF_COLS]])
    rules = ["l.zip5 = r.zip5 AND l.name_first4 = r.name_first4", "l.name_norm = r.name_norm",
             "l.cage_code = r.cage_code", "l.zip5 = r.zip5 AND l.gov_poc_last = r.gov_poc_last",
             "l.entity_url = r.entity_url"]
    key = "CASE " + " ".join(f"WHEN {x} THEN {i}" for i, x in enumerate(rules[:-1])) + " ELSE 4 END"
    gam = ", ".join(f"{_gamma_sql(c)} AS gamma_{c.column}" for c in DEFAULT_COMPARISONS)
    bfs = ", ".join(f"{_bf_sql(c)} AS bf_{c.column}" for c in DEFAULT_COMPARISONS)
    tfs = ", ".join(f"{_tf_sql(c)} AS bf_tf_adj_{c.column}" for c in DEFAULT_COMPARISONS if c.tf_adjust)
    prior_w = _lit(math.log2(PRIOR / (1 - PRIOR)))
    w = prior_w + " + " + " + ".join(f"bf_{c.column}" for c in DEFAULT_COMPARISONS)
    w_tf = w + " + " + " + ".join(f"bf_tf_adj_{c}" for c in TF_COLS)
    return f"""
e AS ({e}),
latest0 AS (SELECT *, {normalizer('legal_name')} AS name_norm, substr(phys_zip, 1, 5) AS zip5,
                   CAST(NULL AS VARCHAR) AS initial_reg_date FROM e),
latest AS (SELECT *, substr(name_norm, 1, 4) AS name_first4 FROM latest0),
li AS (SELECT {', '.join(COLS)} FROM latest WHERE name_norm IS NOT NULL),
{tf_ctes},
rec AS (SELECT li.*, {rec_tf} FROM li {rec_join}),
pairs AS (SELECT {sel}, {key} AS match_key FROM rec l JOIN rec r
          ON l.uei < r.uei AND (({') OR ('.join(rules)}))),
gammas AS (SELECT *, {gam} FROM pairs),
bfs AS (SELECT *, {bfs}, {tfs} FROM gammas),
scored0 AS (SELECT *, {w} AS match_weight, {w_tf} AS match_weight_tf FROM bfs),
scored AS (SELECT *, pow(2.0, match_weight) / (1 + pow(2.0, match_weight)) AS match_probability,
                  pow(2.0, match_weight_tf) / (1 + pow(2.0, match_weight_tf)) AS match_probability_tf
           FROM scored0),
edges AS (SELECT uei_l, uei_r, match_weight, match_probability FROM scored WHERE match_weight >= 5.0),
und AS (SELECT uei_l AS a, uei_r AS b FROM edges UNION SELECT uei_r, uei_l FROM edges),
reach(node, label) AS (SELECT a, a FROM und UNION SELECT und.b, reach.label FROM reach JOIN und ON und.a = reach.node),
labels AS (SELECT node, min(label) AS label FROM reach GROUP BY node),
ids AS (SELECT label, count(*) AS cluster_size, row_number() OVER (ORDER BY label) - 1 AS cluster_id
        FROM labels GROUP BY label),
ec AS (SELECT ids.cluster_id, lb.node AS uei, r.legal_name, r.name_norm, r.phys_city, r.phys_state, r.zip5,
              r.entity_url, r.cage_code, r.primary_naics, r.entity_structure, r.initial_reg_date,
              ids.cluster_size
       FROM labels lb JOIN ids ON ids.label = lb.label LEFT JOIN latest r ON r.uei = lb.node)
"""


def with_base(body: str) -> str:
    return "WITH RECURSIVE " + base_ctes().strip() + "\n" + body


R6 = "round({x}, 6)"


def link_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["normalize_names"] = with_base("SELECT uei, legal_name, name_norm FROM latest")
    q["blocking_keys"] = with_base("SELECT uei, zip5, name_first4 FROM latest")
    q["link_input"] = with_base(f"SELECT {', '.join(COLS)} FROM li")
    q["candidate_pairs"] = with_base("SELECT uei_l, uei_r, match_key FROM pairs")
    q["candidate_pairs_hot_blocks"] = q["candidate_pairs"]
    q["naive_pair_count"] = with_base(
        "SELECT CAST(count(*) * (count(*) - 1) / 2 AS BIGINT) AS naive_pairs FROM li")
    q["entity_cluster"] = with_base("SELECT cluster_id, cluster_size FROM ec WHERE uei = '000000000004'")
    q["blocking_rule_counts"] = with_base("SELECT match_key, count(*) AS n_pairs FROM pairs GROUP BY match_key")
    q["jaro_winkler"] = with_base(
        "SELECT DISTINCT name_norm_l, name_norm_r, jaro_winkler_similarity(name_norm_l, name_norm_r) AS similarity "
        "FROM pairs WHERE name_norm_l IS NOT NULL AND name_norm_r IS NOT NULL")
    gcols = ", ".join(f"gamma_{c.column}" for c in DEFAULT_COMPARISONS)
    q["gamma_vectors"] = with_base(f"SELECT uei_l, uei_r, {gcols} FROM gammas")
    q["gamma_patterns"] = with_base(f"SELECT {gcols}, count(*) AS n_pairs FROM gammas GROUP BY ALL")
    q["term_frequencies"] = with_base(" UNION ALL ".join(
        f"SELECT '{c}' AS comparison, {c} AS value, count(*) AS value_count, "
        f"CAST(count(*) AS DOUBLE) / (SELECT count({c}) FROM li) AS tf FROM li WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in TF_COLS))
    q["score_pairs"] = with_base(
        "SELECT uei_l, uei_r, match_key, round(match_weight, 6) AS match_weight, "
        "round(match_probability, 6) AS match_probability FROM scored WHERE match_weight >= 2.0")
    q["score_pairs_tf"] = with_base(
        "SELECT uei_l, uei_r, match_key, round(match_weight_tf, 6) AS match_weight, "
        "round(match_probability_tf, 6) AS match_probability FROM scored WHERE match_weight_tf >= 2.0")
    bands = ", ".join(f"({float(low)!r}, '{label}')" for low, label in [*WEIGHT_BANDS, (-1e300, WEIGHT_BAND_ELSE)])
    q["weight_bands"] = with_base(f""",
band AS (SELECT low::DOUBLE AS low, label FROM (VALUES {bands}) AS v(low, label)),
placed AS (SELECT max_by(label, low) AS weight_band FROM scored s JOIN band ON match_weight >= low
           WHERE match_weight >= 2.0 GROUP BY uei_l, uei_r)
SELECT weight_band, count(*) AS n_pairs FROM placed GROUP BY weight_band""").replace("\n,\nband", ",\nband")
    q["top_pairs"] = with_base(
        "SELECT uei_l, uei_r, name_norm_l, name_norm_r, phys_city_l, phys_city_r, round(match_weight, 2) AS weight "
        "FROM scored WHERE match_weight >= 2.0 ORDER BY match_weight DESC, uei_l, uei_r LIMIT 10")
    q["edge_threshold"] = with_base(
        "SELECT uei_l, uei_r, round(match_weight, 6) AS match_weight, "
        "round(match_probability, 6) AS match_probability FROM edges")
    q["graph_nodes"] = with_base("SELECT uei_l AS node FROM edges UNION SELECT uei_r FROM edges")
    q["connected_components"] = with_base("SELECT cluster_id, uei, cluster_size FROM ec")
    q["connected_components_incremental"] = q["connected_components"]
    q["entity_clusters"] = with_base("SELECT * FROM ec")
    total = "(SELECT count(*) FROM latest)"
    q["cluster_stats"] = with_base(
        f"SELECT {total} AS total_entities, count(DISTINCT uei) AS clustered, "
        f"round(count(DISTINCT uei) * 100.0 / {total}, 1) AS clustered_pct, "
        f"{total} - count(DISTINCT uei) AS singletons, "
        f"round(({total} - count(DISTINCT uei)) * 100.0 / {total}, 1) AS singletons_pct, "
        f"count(DISTINCT cluster_id) AS n_clusters FROM ec")
    sizes = ", ".join(f"({low}, {high}, '{label}')" for low, high, label in [*SIZE_BANDS, (101, 10 ** 15, SIZE_BAND_ELSE)])
    q["cluster_size_distribution"] = with_base(f""",
band(low, high, size_range) AS (VALUES {sizes})
SELECT size_range, count(*) FILTER (first_member) AS n_clusters, count(*) AS n_entities
FROM (SELECT cluster_size, row_number() OVER (PARTITION BY cluster_id ORDER BY uei) = 1 AS first_member FROM ec)
JOIN band ON cluster_size BETWEEN low AND high GROUP BY size_range""").replace("\n,\nband", ",\nband")
    q["largest_clusters"] = with_base(""",
per_cluster AS (SELECT cluster_id, max(cluster_size) AS members, min(legal_name) AS name, min(phys_city) AS city,
                min(phys_state) AS state FROM ec GROUP BY cluster_id),
placed AS (SELECT *, row_number() OVER (ORDER BY members DESC, cluster_id) AS place FROM per_cluster)
SELECT cluster_id, members AS cluster_size, name AS example_name, city AS example_city, state AS example_state
FROM placed WHERE place <= 10""").replace("\n,\nper_cluster", ",\nper_cluster")
    q["overlink_check"] = with_base(
        f"SELECT max(cluster_size) AS max_cluster_size, {total} AS total_entities, "
        f"round(max(cluster_size) * 100.0 / {total}, 2) AS max_cluster_pct, "
        f"max(cluster_size) * 100.0 / {total} > 1.0 AS overlink FROM ec")
    q["cluster_members"] = with_base(
        "SELECT uei, legal_name, phys_city, phys_state, zip5, entity_url, cage_code, cluster_size FROM ec "
        "WHERE cluster_id = 0 ORDER BY legal_name NULLS LAST, uei LIMIT 50")
    inside = ("inside AS (SELECT e.*, cl.legal_name AS name_l, cr.legal_name AS name_r, cl.phys_city AS city_l, "
              "cr.phys_city AS city_r FROM edges e JOIN ec cl ON cl.uei = e.uei_l JOIN ec cr ON cr.uei = e.uei_r "
              "WHERE cl.cluster_id = 0 AND cr.cluster_id = 0)")

    def within(body: str) -> str:
        return with_base(",\n" + inside + "\n" + body).replace("\n,\ninside", ",\ninside")

    q["cluster_edges"] = within(
        "SELECT uei_l, uei_r, round(match_weight, 1) AS weight FROM inside "
        "ORDER BY match_weight DESC, uei_l, uei_r LIMIT 20")
    q["weakest_edges"] = within(
        "SELECT uei_l, uei_r, round(match_weight, 2) AS weight, name_l, name_r, city_l, city_r "
        "FROM (SELECT *, row_number() OVER (ORDER BY match_weight, uei_l, uei_r) AS place FROM inside) WHERE place <= 15")
    q["entity_members"] = with_base(
        "SELECT m.uei, m.legal_name, m.phys_city, m.phys_state, m.zip5, m.entity_url, m.cage_code, m.cluster_size "
        "FROM ec m JOIN ec own ON own.cluster_id = m.cluster_id AND own.uei = '000000000004' "
        "ORDER BY m.legal_name NULLS LAST, m.uei LIMIT 30")
    q["diagnosed_size"] = with_base(
        "SELECT CAST(0 AS BIGINT) AS cluster_id, count(*) AS cluster_size FROM ec WHERE cluster_id = 0")
    full = []
    for c in DEFAULT_COMPARISONS:
        full += [f"{c.column}_l", f"{c.column}_r", f"gamma_{c.column}", f"bf_{c.column}"]
        if c.tf_adjust:
            full += [f"tf_{c.column}_l", f"tf_{c.column}_r", f"bf_tf_adj_{c.column}"]
    rounded = ("bf_", "tf_")
    q["predictions_full"] = with_base(
        "SELECT uei_l, uei_r, match_key, round(match_weight_tf, 6) AS match_weight, "
        "round(match_probability_tf, 6) AS match_probability, "
        + ", ".join(f"round({c}, 6) AS {c}" if c.startswith(rounded) else c for c in full)
        + " FROM scored WHERE match_weight_tf >= 2.0")
    q["cluster_name_counts"] = with_base(
        "SELECT name_norm, count(*) AS cnt FROM ec WHERE cluster_id = 0 GROUP BY name_norm "
        "ORDER BY cnt DESC, name_norm NULLS LAST LIMIT 10")
    q["cluster_city_counts"] = with_base(
        "SELECT phys_city, phys_state, count(*) AS cnt FROM ec WHERE cluster_id = 0 GROUP BY phys_city, phys_state "
        "ORDER BY cnt DESC, phys_city NULLS LAST, phys_state NULLS LAST LIMIT 10")
    card = ["uei", "legal_name", "dba_name", "phys_addr1", "phys_city", "phys_state", "zip5", "cage_code",
            "entity_url", "primary_naics", "entity_structure", "initial_reg_date", "gov_poc_first",
            "gov_poc_last"]
    present = {"phys_addr1", "gov_poc_first"}
    rows = " UNION ALL ".join(
        f"SELECT {i} AS position, '{f}' AS field, "
        f"{'CAST(NULL AS VARCHAR)' if f in present else f} AS value FROM latest WHERE uei = '000000000004'"
        for i, f in enumerate(card))
    q["entity_lookup"] = with_base(f"SELECT * FROM ({rows}) WHERE value IS NOT NULL AND value <> ''")
    like = "(name_norm LIKE '%' || lower('{q}') || '%' OR legal_name ILIKE '%' || '{q}' || '%')"
    q["name_search"] = with_base(
        "SELECT * FROM (SELECT cluster_id, cluster_size, uei, legal_name, phys_city, phys_state, zip5 FROM ec "
        f"WHERE {like.format(q='ring')} ORDER BY cluster_size DESC, legal_name NULLS LAST, uei LIMIT 25) "
        "UNION ALL SELECT * FROM (SELECT CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), uei, legal_name, phys_city, "
        f"phys_state, zip5 FROM latest WHERE {like.format(q='ring')} "
        f"AND NOT EXISTS (SELECT 1 FROM ec WHERE {like.format(q='ring')}) ORDER BY legal_name NULLS LAST, uei LIMIT 25)")
    q["name_search_indexed"] = q["name_search"]
    grams = "SELECT uei, unnest(list_transform(range(1, greatest(len({c}) - 1, 1)), lambda i: substr({c}, i, 3))) AS gram FROM latest"
    q["search_gram_counts"] = with_base(
        "SELECT gram, count(*) AS n_rows FROM (SELECT DISTINCT uei, gram FROM ("
        f"{grams.format(c='name_norm')} UNION ALL {grams.format(c='lower(legal_name)')})) GROUP BY gram")
    sought = ("(strpos(name_norm, lower((SELECT term FROM alone))) > 0 "
              "OR strpos(lower(legal_name), lower((SELECT term FROM alone))) > 0)")
    q["name_search_unclustered"] = with_base(f""",
alone AS (SELECT min_by(legal_name, uei) AS term FROM latest
          WHERE legal_name IS NOT NULL AND uei NOT IN (SELECT uei FROM ec)),
hits AS (SELECT cluster_id, cluster_size, uei, legal_name, phys_city, phys_state, zip5 FROM ec WHERE {sought}),
every AS (SELECT CAST(NULL AS BIGINT) AS cluster_id, CAST(NULL AS BIGINT) AS cluster_size, uei, legal_name, phys_city,
          phys_state, zip5 FROM latest WHERE {sought} AND (SELECT count(*) FROM hits) = 0)
SELECT * FROM (SELECT * FROM hits ORDER BY cluster_size DESC, legal_name NULLS LAST, uei LIMIT 25)
UNION ALL SELECT * FROM (SELECT * FROM every ORDER BY legal_name NULLS LAST, uei LIMIT 25)""").replace(
        "\n,\nalone", ",\nalone")
    q["name_search_unclustered_indexed"] = q["name_search_unclustered"]
    q["name_search_fallback"] = with_base(
        "SELECT CAST(NULL AS BIGINT) AS cluster_id, CAST(NULL AS BIGINT) AS cluster_size, uei, legal_name, "
        f"phys_city, phys_state, zip5 FROM latest WHERE {like.format(q='gizmo')} "
        "ORDER BY legal_name NULLS LAST, uei LIMIT 25")
    return q


# ------------------------------------------------------------ ingest keys ----


H_COLS = "uei, snapshot_date, line_no, name_norm, phys_city, zip5, source_file"


def snapshot_sql(name: str) -> str:
    d = r"'_(\d{4})(\d{2})(\d{2})\.'"
    m = r"'(?i)_(\d{4})_([A-Z]{3})_'"
    mon = "CASE upper(regexp_extract({n}, {m}, 2)) ".format(n=name, m=m) + " ".join(
        f"WHEN '{x}' THEN '{i + 1:02d}'" for i, x in enumerate(MONTHS)) + " ELSE '01' END"
    return (f"CASE WHEN regexp_matches({name}, {d}) THEN CAST(regexp_extract({name}, {d}, 1) || '-' || "
            f"regexp_extract({name}, {d}, 2) || '-' || regexp_extract({name}, {d}, 3) AS DATE) "
            f"WHEN regexp_matches({name}, {m}) THEN CAST(regexp_extract({name}, {m}, 1) || '-' || {mon} || '-01' AS DATE) "
            "ELSE DATE '1970-01-01' END")


def _h(where: str = "") -> str:
    return f"SELECT * FROM ({HISTORY_SQL.replace('{orders}', 'orders')}) h {where}"


def _dedupe(src: str) -> str:
    return (f"SELECT {H_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY uei, snapshot_date "
            f"ORDER BY line_no DESC) AS rn FROM ({src}) x) y WHERE rn = 1")


def ingest_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    reg = _dedupe(_h())
    q["dedupe_keep_last"] = reg
    stored, incoming = _dedupe(_h("WHERE line_no % 2 = 0")), _dedupe(_h("WHERE line_no % 2 = 1"))
    q["upsert_by_key"] = (
        f"SELECT {H_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY uei, snapshot_date ORDER BY seq DESC) rn "
        f"FROM (SELECT *, 0 AS seq FROM ({stored}) s UNION ALL SELECT *, 1 FROM ({incoming}) i) u) z WHERE rn = 1")
    latest = (f"SELECT r.* FROM ({reg}) r JOIN (SELECT uei, max(snapshot_date) AS md FROM ({reg}) g GROUP BY uei) m "
              "ON r.uei = m.uei AND r.snapshot_date = m.md")
    q["latest_per_key"] = latest
    q["history_names"] = (f"SELECT uei, list_sort(list(DISTINCT name_norm)) AS all_names FROM ({reg}) r "
                          "WHERE name_norm IS NOT NULL GROUP BY uei")
    q["history_locations"] = (
        f"SELECT uei, list_sort(list(DISTINCT phys_city || '|' || zip5), 'ASC', 'NULLS LAST') AS all_locations "
        f"FROM ({reg}) r WHERE zip5 IS NOT NULL GROUP BY uei")
    # Brought up to date load by load, the derived tables equal the full ones.
    for name in ("latest_per_key", "history_names", "history_locations"):
        q[f"{name}_incremental"] = q[name]
    q["sample_latest"] = (f"SELECT uei, name_norm, phys_city, zip5, snapshot_date FROM ({latest}) l "
                          "ORDER BY name_norm NULLS LAST, uei LIMIT 5")
    q["ingest_counts"] = (f"SELECT count(*) AS total_rows, count(DISTINCT snapshot_date) AS snapshots, "
                          f"count(DISTINCT uei) AS unique_ueis FROM ({reg}) r")

    fields = ", ".join(f"nullif(trim(f[{pos + 1}]), '') AS {name}" for pos, name in SOURCE_POSITIONS)
    parsed = f"""
WITH lines AS ({customer_lines_sql('customer')}),
k AS (SELECT source_file, line_no, regexp_replace(raw, '[\\r\\n]+$', '') AS raw FROM lines),
s AS (SELECT source_file, line_no, string_split(raw, '|') AS f FROM k
      WHERE NOT (line_no = 0 AND starts_with(raw, 'BOF')) AND raw <> '' AND NOT starts_with(raw, '!end')),
r AS (SELECT source_file, line_no, {fields} FROM s WHERE len(f) >= 122),
r2 AS (SELECT *, {normalizer('legal_name')} AS name_norm, substr(phys_zip, 1, 5) AS zip5,
              {snapshot_sql('source_file')} AS snapshot_date
       FROM r WHERE uei IS NOT NULL AND uei <> '!end'),
r3 AS (SELECT *, substr(name_norm, 1, 4) AS name_first4,
              row_number() OVER (PARTITION BY uei, snapshot_date ORDER BY line_no DESC) AS rn FROM r2)
SELECT {', '.join(REGISTRATION_COLUMNS)} FROM r3 WHERE rn = 1"""
    q["scan_delimited"] = parsed
    archived = parsed.replace(f"WITH lines AS ({customer_lines_sql('customer')})", f"WITH lines AS ("
                              f"SELECT archive AS source_file, load_pos * 1000000000 + line_no AS line_no, raw "
                              f"FROM ({archive_lines_sql('customer')}))")
    q["scan_archives"] = archived

    lst = f"WITH listing AS ({listing_sql('orders')}) "
    q["snapshot_dates"] = lst + f"SELECT name, {snapshot_sql('name')} AS snapshot_date FROM listing"
    ordered = lst + f""", r AS (
  SELECT folder, name, CASE folder WHEN 'Public V2' THEN 0 WHEN 'Public - Historical' THEN 1 END AS fr,
         CASE WHEN ends_with(name, '.ZIP') THEN 0 WHEN ends_with(name, '.zip') THEN 1 END AS sr FROM listing),
o AS (SELECT *, {snapshot_sql('name')} AS snapshot_date,
             row_number() OVER (PARTITION BY lower(name) ORDER BY fr, sr, name) AS rn
      FROM r WHERE fr IS NOT NULL AND sr IS NOT NULL)
"""
    q["source_file_select"] = ordered + "SELECT folder, name, snapshot_date FROM o WHERE rn = 1 AND NOT contains(name, 'UTF-8')"
    q["source_file_first"] = ordered + (
        "SELECT folder, name, snapshot_date FROM (SELECT *, 0 AS pref FROM o WHERE rn = 1 AND contains(name, 'V2') "
        "AND NOT contains(name, 'UTF-8') UNION ALL SELECT *, 1 FROM o WHERE rn = 1) ORDER BY pref, fr, sr, name LIMIT 1")
    q["source_file_latest"] = ordered + (
        "SELECT folder, name, snapshot_date FROM o WHERE rn = 1 AND contains(name, 'V2') AND NOT contains(name, 'UTF-8') "
        "ORDER BY snapshot_date DESC, fr, sr, name LIMIT 1")
    q["incremental_new_files"] = ordered.replace("WITH listing AS", f"WITH loaded AS ({loaded_sql('orders')}), listing AS") + (
        "SELECT folder, name, snapshot_date FROM o WHERE rn = 1 AND NOT contains(name, 'UTF-8') "
        "AND name NOT IN (SELECT source_file FROM loaded)")
    q["pending_archives"] = q["incremental_new_files"].replace(
        "(SELECT source_file FROM loaded)", "(SELECT source_file FROM loaded WHERE NOT contains(source_file, '5'))")
    flat = (lst + ", e AS (SELECT folder, 'Entity Registration/' || folder || '/' || name AS key, name AS display_key, "
            "CAST(y AS VARCHAR) || '-' || lpad(CAST(mo AS VARCHAR), 2, '0') || '-15' AS date_modified, "
            "folder || '/' || name AS local_path FROM listing)")
    present = f", p AS ({present_sql('listing', 'orders')})"
    q["listing_flatten"] = flat + " SELECT * FROM e"
    status = (flat + present + ", st AS (SELECT e.folder, e.display_key AS name, e.date_modified, "
              "p.size_bytes IS NOT NULL AS downloaded, round(p.size_bytes / (1024.0 * 1024.0), 1) AS size_mb "
              "FROM e LEFT JOIN (SELECT lower(name) AS lname, max(size_bytes) AS size_bytes FROM p GROUP BY 1) p "
              "ON lower(e.display_key) = p.lname) ")
    q["manifest_status"] = status + "SELECT * FROM st"
    q["manifest_progress"] = status + ("SELECT folder, CAST(sum(CAST(downloaded AS BIGINT)) AS BIGINT) AS done, "
                                       "count(*) AS total FROM st GROUP BY folder")
    q["manifest_missing"] = flat + present + (" SELECT folder, key, display_key AS name FROM e "
                                              "WHERE lower(display_key) NOT IN (SELECT lower(name) FROM p)")
    ent = "replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')"
    links = f"""
WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\\b[^>]*>.*?</a>')) AS anchor,
                  unnest(range(len(regexp_extract_all(html, '(?is)<a\\b[^>]*>.*?</a>')))) AS link_pos FROM pages),
t AS (SELECT page_id, link_pos, trim({ent.format(x="regexp_replace(regexp_extract(anchor, '(?is)^<a\\b[^>]*>(.*)</a>$', 1), '<[^>]*>', '', 'g')")}) AS link_text FROM a)
"""
    q["page_links_class"] = links + "SELECT page_id, link_pos, link_text FROM t WHERE link_text <> '' AND page_id % 2 = 0"
    q["page_links"] = links + "SELECT page_id, link_pos, link_text FROM t WHERE link_text <> ''"
    q["page_links_parsed"] = q["page_links"]
    q["page_links_broken"] = q["page_links"] + (
        " UNION ALL SELECT page_id, len(regexp_extract_all(html, '(?is)<a\\b[^>]*>.*?</a>')) AS link_pos, "
        "'tail' || page_id || 'end' FROM pages WHERE html IS NOT NULL")
    q["page_link_counts"] = links + "SELECT page_id, count(*) AS n_links FROM t WHERE link_text <> '' GROUP BY page_id"
    return q


# ------------------------------------------------------------- model keys ----

def _levels_sql(u_query: str) -> str:
    """CTEs: every (comparison, gamma) with its floored start u and default m."""
    rows = ", ".join(f"('{c.column}', {g}, {len(c.levels)}, {c.exact_level})" for c in DEFAULT_COMPARISONS for g in c.levels)
    return f"""
u_raw AS MATERIALIZED ({u_query}),
u_floor AS (SELECT l.*, greatest(coalesce(u_probability, 0), 1e-6) AS f
            FROM (VALUES {rows}) AS l(comparison, gamma, n_levels, exact_level) LEFT JOIN u_raw USING (comparison, gamma)),
lv0 AS MATERIALIZED (SELECT comparison, gamma, gamma = exact_level AS is_exact, f / sum(f) OVER (PARTITION BY comparison) AS u,
            CASE WHEN gamma = exact_level THEN 0.95::DOUBLE ELSE 0.05::DOUBLE / (n_levels - 1) END AS m FROM u_floor)"""


def _em_sql(name: str, block: tuple[str, ...], source: str) -> str:
    """CTEs of one EM pass over the pattern counts of ``source``, a step at a
    time; a step after convergence hands its input on."""
    active = [c for c in DEFAULT_COMPARISONS if c.column not in block]
    gammas = ", ".join(f"gamma_{c.column}" for c in DEFAULT_COMPARISONS)
    long = " UNION ALL ".join(f"SELECT pid, n, '{c.column}' AS comparison, gamma_{c.column} AS gamma FROM {name}_pat "
                              f"WHERE gamma_{c.column} >= 0" for c in active)
    names = ", ".join(f"'{c.column}'" for c in active)
    blocked = ", ".join(f"'{b}'" for b in block)
    parts = [f"""
{name}_pat AS MATERIALIZED (SELECT row_number() OVER (ORDER BY {gammas}) AS pid, {gammas}, n::DOUBLE AS n
    FROM (SELECT {gammas}, count(*) AS n FROM ({source}) GROUP BY ALL)),
{name}_long AS MATERIALIZED ({long}),
{name}_m0 AS MATERIALIZED (SELECT comparison, gamma, u, m FROM lv0 WHERE comparison IN ({names})),
{name}_s0 AS MATERIALIZED (SELECT least(o / (1 + o), 0.5) AS prior, (SELECT count(*) FROM {name}_pat) = 0 AS done FROM (
    SELECT {PRIOR!r}::DOUBLE / (1 - {PRIOR!r}::DOUBLE) * coalesce(product(m / u), 1) AS o FROM lv0
    WHERE is_exact AND comparison IN ({blocked})))"""]
    for i in range(1, DEFAULT_MAX_ITERATIONS + 1):
        was = i - 1
        parts.append(f"""
{name}_p{i} AS MATERIALIZED (SELECT pid, p.n, any_value(prior) AS prior,
    1 / (1 + exp(coalesce(sum(ln(u) - ln(m)), 0) + ln(1 - any_value(prior)) - ln(any_value(prior)))) * p.n AS pn
    FROM {name}_pat p CROSS JOIN {name}_s{was} LEFT JOIN {name}_long USING (pid) LEFT JOIN {name}_m{was} USING (comparison, gamma)
    GROUP BY pid, p.n),
{name}_r{i} AS (SELECT comparison, gamma, sum(pn) AS pn FROM {name}_long JOIN {name}_p{i} USING (pid) GROUP BY ALL),
{name}_f{i} AS (SELECT comparison, gamma, u, m, greatest(coalesce(pn / nullif(sum(pn) OVER (PARTITION BY comparison), 0), 0), 1e-6) AS f
    FROM {name}_m{was} LEFT JOIN {name}_r{i} USING (comparison, gamma)),
{name}_m{i} AS MATERIALIZED (SELECT comparison, gamma, u,
    CASE WHEN (SELECT done FROM {name}_s{was}) THEN m ELSE f / sum(f) OVER (PARTITION BY comparison) END AS m FROM {name}_f{i}),
{name}_s{i} AS MATERIALIZED (SELECT CASE WHEN done THEN prior ELSE (SELECT sum(pn) / sum(n) FROM {name}_p{i}) END AS prior,
    done OR (SELECT max(abs(a.m - b.m)) FROM {name}_m{i} a JOIN {name}_m{was} b USING (comparison, gamma)) < {DEFAULT_EM_CONVERGENCE!r} AS done
    FROM {name}_s{was})""")
    return ",".join(parts)


def _training_sql(u_query: str) -> str:
    """CTEs ending in ``trained(comparison, gamma, m, u, bf)``."""
    by_name = "SELECT * FROM gammas WHERE name_norm_l = name_norm_r"
    gam = ", ".join(f"{_gamma_sql(c)} AS gamma_{c.column}" for c in DEFAULT_COMPARISONS)
    sel = ", ".join([f"l.{c} AS {c}_l" for c in COLS] + [f"r.{c} AS {c}_r" for c in COLS])
    by_place = (f"SELECT *, {gam} FROM (SELECT {sel} FROM li l JOIN li r ON l.uei < r.uei AND l.zip5 = r.zip5 "
                "AND l.phys_city = r.phys_city)")
    first, second = DEFAULT_TRAINING_BLOCKS
    last = DEFAULT_MAX_ITERATIONS
    return (_levels_sql(u_query) + "," + _em_sql("one", first, by_name) + "," + _em_sql("two", second, by_place) + f""",
mean AS (SELECT comparison, gamma, avg(m) AS m FROM (
    SELECT comparison, gamma, m FROM one_m{last} WHERE (SELECT count(*) FROM one_pat) > 0
    UNION ALL SELECT comparison, gamma, m FROM two_m{last} WHERE (SELECT count(*) FROM two_pat) > 0) GROUP BY ALL),
trained AS MATERIALIZED (SELECT comparison, gamma, coalesce(mean.m, lv0.m) AS m, u, log2(coalesce(mean.m, lv0.m) / u) AS bf
    FROM lv0 LEFT JOIN mean USING (comparison, gamma))""")


def _trained_stats_sql() -> str:
    """Cluster statistics of the pairs scored with the trained table."""
    wide = ", ".join(f"max(bf) FILTER (comparison = '{c.column}' AND gamma = {g}) AS bf_{c.column}_{g}"
                     for c in DEFAULT_COMPARISONS for g in c.levels)
    exact = ", ".join(f"max(u) FILTER (comparison = '{c.column}' AND gamma = {c.exact_level}) AS ux_{c.column}"
                      for c in DEFAULT_COMPARISONS if c.tf_adjust)
    terms = [_lit(math.log2(PRIOR / (1 - PRIOR)))]
    for c in DEFAULT_COMPARISONS:
        cases = " ".join(f"WHEN {g} THEN bf_{c.column}_{g}" for g in c.levels)
        terms.append(f"CASE gamma_{c.column} {cases} ELSE 0 END")
        if c.tf_adjust:
            tf = f"greatest(tf_{c.column}_l, tf_{c.column}_r)"
            terms.append(f"CASE WHEN gamma_{c.column} = {c.exact_level} AND {tf} IS NOT NULL THEN log2(ux_{c.column} / {tf}) ELSE 0 END")
    total = "(SELECT count(*) FROM latest)"
    return f""",
wide AS (SELECT {wide}, {exact} FROM trained),
tedges AS MATERIALIZED (SELECT uei_l, uei_r FROM gammas CROSS JOIN wide WHERE {' + '.join(terms)} >= 5.0),
tund AS (SELECT uei_l AS a, uei_r AS b FROM tedges UNION SELECT uei_r, uei_l FROM tedges),
treach(node, label) AS (SELECT a, a FROM tund UNION SELECT tund.b, treach.label FROM treach JOIN tund ON tund.a = treach.node),
tlabel AS (SELECT node, min(label) AS label FROM treach GROUP BY node),
tcount AS (SELECT count(*) AS clustered, count(DISTINCT label) AS n_clusters FROM tlabel)
SELECT {total} AS total_entities, clustered, round(clustered * 100.0 / {total}, 1) AS clustered_pct,
  {total} - clustered AS singletons, round(({total} - clustered) * 100.0 / {total}, 1) AS singletons_pct, n_clusters FROM tcount"""


def model_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    comps = DEFAULT_COMPARISONS
    h = "('0x' || substr(md5({k}), 1, 15))::BIGINT"
    sel = ", ".join([f"a.{c} AS {c}_l" for c in COLS] + [f"b.{c} AS {c}_r" for c in COLS])
    gam = ", ".join(f"{_gamma_sql(c)} AS gamma_{c.column}" for c in comps)
    stack = " UNION ALL ".join(
        f"SELECT '{c.column}' AS comparison, gamma_{c.column} AS gamma FROM rg" for c in comps)
    def u_query(most: int) -> str:
        return with_base(",\n" + u_body(most)).replace("\n,\nnp AS", ",\nnp AS")

    def u_body(most: int) -> str:
        return (f"""np AS (SELECT count(*) AS n FROM li),
claimed AS (SELECT n, CASE WHEN n * (n - 1) // 2 <= {most} THEN n
            ELSE least(n, (2 * {most} + n - 2) // (n - 1)) END AS claims FROM np),
plan AS (SELECT n AS slots, claims, CASE WHEN n * (n - 1) // 2 <= {most} THEN n
         ELSE least(n, round(2.0::DOUBLE * {most} * n / ((n - 1) * claims))::BIGINT) END AS counting FROM claimed),
sa AS (SELECT li.*, {h.format(k="uei || ':a42'")} % plan.slots AS st, unnest(range(0, plan.claims)) AS k
       FROM li, plan),
a AS (SELECT sa.*, (st + k) % plan.slots AS slot FROM sa, plan WHERE (st + k) % plan.slots < counting),
b AS (SELECT li.*, {h.format(k="uei || ':b42'")} % plan.slots AS slot FROM li, plan),
rp AS (SELECT {sel} FROM a JOIN b ON a.slot = b.slot AND a.uei < b.uei),
rg AS (SELECT {gam} FROM rp),
lv AS (SELECT comparison, gamma, count(*) AS c FROM ({stack}) WHERE gamma >= 0 GROUP BY ALL)
SELECT comparison, gamma, c / sum(c) OVER (PARTITION BY comparison) AS u_probability FROM lv""")

    training = with_base(",\n" + _training_sql("WITH " + u_body(DEFAULT_U_MAX_PAIRS)).strip()).replace("\n,\nu_raw", ",\nu_raw")
    q["match_weight_table"] = training + """
SELECT comparison, gamma, round(m, 6) AS m_probability, round(u, 6) AS u_probability, round(bf, 6) AS log2_bayes_factor FROM trained"""
    q["trained_cluster_stats"] = training + _trained_stats_sql()
    q["u_estimates"] = u_query(DEFAULT_U_MAX_PAIRS)
    q["u_estimates_small_sample"] = u_query(SMALL_U_SAMPLE)

    def lsum(key: int) -> str:
        terms = []
        for c in comps:
            parts = " ".join(f"WHEN gamma_{c.column} = {g} THEN {_lit(math.log(FIXED_LEVELS[c.column][g][key]))}"
                             for g in c.levels)
            terms.append(f"(CASE {parts} ELSE CAST(0 AS DOUBLE) END)")
        return " + ".join(terms)
    gcols = ", ".join(f"gamma_{c.column}" for c in comps)
    stack2 = " UNION ALL ".join(
        f"SELECT '{c.column}' AS comparison, gamma_{c.column} AS gamma, pn FROM post" for c in comps)
    q["em_one_step"] = with_base(f""",
pat AS (SELECT {gcols}, count(*) AS n_pairs FROM gammas GROUP BY ALL),
lp AS (SELECT *, {lsum(0)} + {_lit(math.log(PRIOR))} AS lm, {lsum(1)} + {_lit(math.log(1 - PRIOR))} AS lu FROM pat),
post AS (SELECT *, 1.0 / (1.0 + exp(lu - lm)) * n_pairs AS pn FROM lp),
share AS (SELECT sum(pn) / sum(n_pairs) AS s FROM post),
per AS (SELECT comparison, gamma, sum(pn) AS pn FROM ({stack2}) WHERE gamma >= 0 GROUP BY ALL)
SELECT comparison, gamma, round(pn / sum(pn) OVER (PARTITION BY comparison), 6) AS m_probability,
       round((SELECT s FROM share), 6) AS match_share FROM per""").replace("\n,\npat AS", ",\npat AS")
    return q
