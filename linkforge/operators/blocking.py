"""Candidate-pair generation by blocking rules.

A pair is a candidate when ANY rule matches; each pair is produced once,
tagged with the first matching rule (``match_key``), and ``id_l < id_r``.

Plan shape: one equi self-join per rule, each excluding the pairs an
earlier rule already produced, combined with ``unionByName``. An OR of
equalities in one join would be planned as a nested-loop join.

Skew: a block (one key value of a rule) may hold a large share of all rows,
and its output grows with the square of its size. A block of n rows above
``hot_block_rows`` (L) is dealt into g = ceil(n / L) parts by ranges of the id
(bounds from a sample of the block's ids) and joined cell by cell: cell (p, q),
p <= q, joins the rows of part p, as left ones, with those of part q, so a row
is copied g + 1 times over both sides (n * g, about n^2 / L rows, against the
n^2 / 2 pairs the block must give). All ids of part p are below those of q, so
nearly each two rows that meet are a pair; only within a part's own cell do
both orders meet. A cell gives about L^2 pairs, the share of one or two
ordinary tasks, whatever n is. Nothing is dropped or capped: the sample decides
how even the parts are, never which pairs are found. The joins have an explicit
partition count (their output dwarfs their input), which AQE does not split;
hence the low L.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, work_partitions
from ..settings import LinkSettings

# Cells below this size balance nothing more and only cost copies: a block is
# dealt into more than so many parts only if its cells would else exceed it.
ORDINARY_CELL_ROWS = 2_000
SMALL_CELL_PARTS = 16

# Hot-block keys are broadcast only while their count is at most this, and
# that of their parts at most the other.
HOT_KEYS_BROADCAST_LIMIT = 100_000
HOT_PARTS_BROADCAST_LIMIT = 1_000_000

# Ids of a hot block that are looked at for each of its parts.
BOUND_IDS_PER_PART = 48


# Rules up to which their first matches are counted from block sizes: the
# column sets to count double with each rule.
MOST_COUNTED_RULES = 8


@dataclass(frozen=True)
class Candidates:
    """The records and rules of which a frame holds all candidate pairs, each
    once. What is known of the pairs from their blocks alone need not list them."""

    records: DataFrame
    rules: tuple[tuple[str, ...], ...]
    uid: str


def candidates_of(pairs: DataFrame) -> Candidates | None:
    """Set on the frames of ``candidate_pairs`` and of steps that keep every
    pair; any other step (a filter, a projection) gives a frame without."""
    return pairs.__dict__.get("_candidates")


def with_candidates(pairs: DataFrame, of: Candidates | None) -> DataFrame:
    if of is not None:
        pairs.__dict__["_candidates"] = of
    return pairs


def _side(records: DataFrame, cols: list[str], suffix: str) -> DataFrame:
    return records.select([F.col(c).alias(f"{c}{suffix}") for c in cols])


def _rule_match(rule: tuple[str, ...]) -> Column:
    """True when every key of the rule is equal (and so non-null) on both ends."""
    return reduce(lambda a, b: a & b, [F.col(f"{k}_l") == F.col(f"{k}_r") for k in rule])


def _all_held_hash(columns: tuple[str, ...]) -> Column:
    """Hash of the columns' values; NULL where one is missing."""
    held = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in columns])
    return F.when(held, F.xxhash64(*columns))


def _same(column: str) -> Column:
    return F.coalesce(F.col(f"{column}_l") == F.col(f"{column}_r"), F.lit(False))


def _key_string(rule: tuple[str, ...], suffix: str = "") -> Column:
    # \u0001 cannot appear in the delimited source, so the join of key parts is unambiguous.
    return F.concat_ws("\u0001", *[F.col(f"{k}{suffix}").cast("string") for k in rule])


def block_sizes(records: DataFrame, rules) -> DataFrame:
    """(rule, block_key, block_rows): one partial-aggregated pass over the
    records for all rules (NULL keys form no block)."""
    parts = []
    for i, rule in enumerate(rules):
        keyed = records.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in rule]))
        parts.append(keyed.select(F.lit(i).alias("rule"), _key_string(rule).alias("block_key")))
    return reduce(DataFrame.unionByName, parts).groupBy("rule", "block_key").agg(
        F.count(F.lit(1)).alias("block_rows"))


def rule_workload(sizes: DataFrame, hot_block_rows: int) -> dict[int, tuple[float, int]]:
    """rule -> (upper bound of its pairs = sum n(n-1)/2 over blocks, hot
    blocks). One row per rule reaches the driver."""
    n = F.col("block_rows").cast("double")
    rows = (sizes.groupBy("rule")
                 .agg(F.sum(n * (n - 1) / 2).alias("pairs"),
                      F.sum((F.col("block_rows") > hot_block_rows).cast("long")).alias("hot"))
                 .collect())
    return {int(r["rule"]): (float(r["pairs"] or 0.0), int(r["hot"] or 0)) for r in rows}


def hot_blocks(records: DataFrame, rules, hot_block_rows: int, sizes: DataFrame | None = None) -> DataFrame:
    """(rule, block_key, block_rows, n_parts) for every block larger than the
    limit. A limit below the ordinary one holds up to SMALL_CELL_PARTS parts;
    beyond, cells may reach the ordinary size, so that copies don't grow with
    n^2 / limit."""
    counts = sizes if sizes is not None else block_sizes(records, rules)
    most = F.greatest(F.lit(SMALL_CELL_PARTS), F.ceil(F.col("block_rows") / F.lit(float(ORDINARY_CELL_ROWS))))
    return (counts.where(F.col("block_rows") > F.lit(hot_block_rows))
                  .withColumn("n_parts", F.least(
                      F.ceil(F.col("block_rows") / F.lit(float(hot_block_rows))), most).cast("int")))


def _in_cells(side: DataFrame, suffix: str, rule: tuple[str, ...], rule_hot: DataFrame, uid: str) -> DataFrame:
    """Adds the row's part (by the block's bounds; by a hash of the id where
    there are none) and, for each cell it belongs to, cell_lo and cell_hi (0, 0
    once for rows of ordinary blocks)."""
    part, other, id_ = F.col(f"part{suffix}"), F.col(f"other{suffix}"), F.col(f"{uid}{suffix}")
    by_id = (F.coalesce(F.array_size(F.filter("bounds", lambda b: b <= id_)), F.lit(0)) if "bounds" in rule_hot.columns
             else F.pmod(F.xxhash64(id_), F.col("n_parts")).cast("int"))
    return (side.join(rule_hot.withColumnRenamed("block_key", "bk"), _key_string(rule, suffix) == F.col("bk"), "left")
                .withColumn("n_parts", F.coalesce("n_parts", F.lit(1)))
                .withColumn(f"part{suffix}", F.when(F.col("n_parts") > 1, by_id).otherwise(F.lit(0)))
                .withColumn(f"other{suffix}", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)))
                .withColumns({f"cell_lo{suffix}": F.least(part, other), f"cell_hi{suffix}": F.greatest(part, other)})
                .drop("bk", "n_parts", "bounds", f"other{suffix}"))


def with_bounds(records: DataFrame, rules, hot: DataFrame, uid: str) -> DataFrame:
    """Hot blocks with ``bounds``: for parts 1 to n_parts - 1 the least id of
    each, from the ids of the block whose hash is low."""
    sampled = []
    for at, rule in rules:
        keyed = records.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in (uid, *rule)]))
        of_rule = hot.where(F.col("rule") == at).select(F.col("block_key").alias("bk"), "block_rows", "n_parts")
        share = F.col("n_parts") * F.lit(float(BOUND_IDS_PER_PART)) / F.col("block_rows")
        low = F.pmod(F.xxhash64(F.col(uid), F.lit(at)), F.lit(1 << 30)) < share * F.lit(float(1 << 30))
        sampled.append(keyed.join(of_rule, _key_string(rule) == F.col("bk")).where(low)
                            .select(F.lit(at).alias("rule"), F.col("bk").alias("block_key"), F.col(uid).alias("_id")))
    ids = reduce(DataFrame.unionByName, sampled).groupBy("rule", "block_key").agg(
        F.sort_array(F.collect_list("_id")).alias("_ids"))
    at_bound = F.transform(F.sequence(F.lit(1), F.col("n_parts") - 1),
                           lambda p: F.element_at("_ids", (p * F.size("_ids") / F.col("n_parts")).cast("int") + 1))
    return (hot.join(ids, ["rule", "block_key"], "left")
               .withColumn("bounds", F.when(F.col("_ids").isNotNull() & (F.col("n_parts") > 1), at_bound)).drop("_ids"))


def bounded_blocks(records: DataFrame, rules, limit: int, sizes: DataFrame, workload: dict[int, tuple[float, int]],
                   uid: str) -> DataFrame:
    """The hot blocks with their parts' bounds, written; to be broadcast if few."""
    in_hot = [at for at, (_, h) in sorted(workload.items()) if h]
    parts_of = materialize(hot_blocks(records, rules, limit, sizes.where(F.col("rule").isin(in_hot))), "hot-parts")
    n_parts = parts_of.agg(F.sum("n_parts")).first()[0]
    few = sum(h for _, h in workload.values()) <= HOT_KEYS_BROADCAST_LIMIT and n_parts <= HOT_PARTS_BROADCAST_LIMIT
    bounded = with_bounds(records, [(at, rules[at]) for at in in_hot], F.broadcast(parts_of) if few else parts_of, uid)
    hot = materialize(bounded.select("rule", "block_key", "n_parts", "bounds"), "hot-blocks")
    return F.broadcast(hot) if few else hot


def _joins(rules, agreeing: dict[int, list[tuple[str, ...]]] | None) -> list[tuple[int, tuple[str, ...], list[tuple[str, ...]]]]:
    """(rule, join columns, column sets of the rule joined before) per join."""
    out = []
    for i, rule in enumerate(rules):
        sets = [()] if agreeing is None else agreeing[i]
        for at, added in enumerate(sets):
            out.append((i, tuple(dict.fromkeys([*rule, *added])), sets[:at]))
    return out


def candidate_pairs(records: DataFrame, settings: LinkSettings | None = None,
                    rules: tuple[tuple[str, ...], ...] | None = None,
                    carry: list[str] | None = None,
                    hot_block_rows: int | None = None,
                    agreeing: dict[int, list[tuple[str, ...]]] | None = None) -> DataFrame:
    """All candidate pairs with ``<col>_l``/``<col>_r`` for the carried columns
    (the ones the comparisons need, so no join back is required) and ``match_key``.

    ``agreeing`` (rule -> column sets, see ``agreement``): only the pairs that
    also agree in all columns of one of the rule's sets (and those whose
    values there have equal hashes). Each set is a join of its own, on the
    rule's columns and one hash of the set's, so that the other pairs of the
    rule's blocks never meet; a pair comes from the first set whose hashes are
    equal, so once, with the same ``match_key``.

    Whether an earlier join gives a pair is asked for each pair that meets, so
    hashes made once for each record answer it; only where those of a rule are
    equal are its columns compared."""
    settings = settings or LinkSettings()
    rules = tuple(rules if rules is not None else settings.blocking_rules)
    uid = settings.unique_id
    if carry is None:
        carry = settings.record_columns()
    cols = [uid] + [c for c in carry if c != uid]
    for rule in [*rules, *[added for sets in (agreeing or {}).values() for added in sets]]:
        for k in rule:
            if k not in cols:
                cols.append(k)
    limit = hot_block_rows if hot_block_rows is not None else settings.hot_block_rows
    recs = records.select(*cols)
    spark = records.sparkSession

    joins = _joins(rules, agreeing)
    if not joins:
        # No rule can give such a pair.
        none = _side(recs, cols, "_l").join(_side(recs, cols, "_r"), F.col(f"{uid}_l") == F.col(f"{uid}_r"))
        return none.where(F.lit(False)).withColumn("match_key", F.lit(0))

    added_sets = list(dict.fromkeys(tuple(added) for sets in (agreeing or {}).values() for added in sets if added))
    set_hash = {added: f"_agree_{n}" for n, added in enumerate(added_sets)}
    rule_hash = {rule: f"_rule_{n}" for n, rule in enumerate(dict.fromkeys(rules))}
    recs = recs.select("*", *[_all_held_hash(k).alias(name) for k, name in [*set_hash.items(), *rule_hash.items()]])

    def joined_on(i: int, before: list[tuple[str, ...]]) -> tuple[str, ...]:
        added = tuple(agreeing[i][len(before)]) if agreeing is not None else ()
        return (*rules[i], set_hash[added]) if added else tuple(rules[i])

    join_keys = tuple(joined_on(i, before) for i, _, before in joins)

    # One aggregation job sizes every join: its pair volume (for the
    # partition count) and its hot blocks (for salting).
    sizes = block_sizes(recs, join_keys)
    workload = rule_workload(sizes, limit)
    n_hot = sum(h for _, h in workload.values())
    if n_hot:
        # Written once: every rule reads it, for both of its sides.
        hot = bounded_blocks(recs, join_keys, limit, sizes, workload, uid)

    outputs = []
    for at, (i, _, before) in enumerate(joins):
        rule = join_keys[at]
        helpers = list(dict.fromkeys([rule_hash[r] for r in rules[:i]] + [set_hash[tuple(s)] for s in before if s]
                                     + [k for k in rule if k not in cols]))
        # Rows without a key or an id meet none.
        keyed = recs.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in (uid, *rule)]))
        left = _side(keyed, cols + helpers, "_l")
        right = _side(keyed, cols + helpers, "_r")
        keys = list(rule)
        pairs, in_cells = workload.get(at, (0.0, 0))
        if in_cells:
            rule_hot = hot.where(F.col("rule") == at).drop("rule")
            left = _in_cells(left, "_l", rule, rule_hot, uid).where("part_l = cell_lo_l").drop("part_l")
            right = _in_cells(right, "_r", rule, rule_hot, uid).where("part_r = cell_hi_r").drop("part_r")
            keys += ["cell_lo", "cell_hi"]
        # Hash-partition both sides on the join keys with an explicit count:
        # the join's output (pairs) dwarfs its input (records), so the
        # partition count must follow the work, not the input bytes.
        parts = work_partitions(spark, pairs)
        left = left.repartition(parts, *[f"{k}_l" for k in keys])
        right = right.repartition(parts, *[f"{k}_r" for k in keys])
        in_order = F.col(f"{uid}_l") < F.col(f"{uid}_r")
        if in_cells:
            in_order = (F.col("cell_lo_l") < F.col("cell_hi_l")) | in_order
        cond = [F.col(f"{k}_l") == F.col(f"{k}_r") for k in keys] + [in_order]
        joined = left.join(right, reduce(lambda a, b: a & b, cond), "inner")
        if in_cells:
            joined = joined.drop(*[f"{c}{side}" for c in ("cell_lo", "cell_hi") for side in ("_l", "_r")])
        for added in before:
            joined = joined.where(~_same(set_hash[tuple(added)]) if added else F.lit(False))
        for earlier in rules[:i]:
            joined = joined.where(~(_same(rule_hash[earlier]) & F.coalesce(_rule_match(earlier), F.lit(False))))
        joined = joined.drop(*[f"{c}{side}" for c in helpers for side in ("_l", "_r")])
        outputs.append(joined.withColumn("match_key", F.lit(i)))
    pairs = reduce(lambda a, b: a.unionByName(b), outputs)
    return pairs if agreeing is not None else with_candidates(pairs, Candidates(records, rules, uid))


def comparable(records: DataFrame, column: str) -> Column:
    """The column so that equal values (0.0 and -0.0 too) have equal text."""
    fractional = dict(records.dtypes)[column] in ("double", "float")
    return F.col(column) + F.lit(0.0) if fractional else F.col(column)


def _signed_sets(rules) -> dict[tuple[str, ...], dict[int, int]]:
    """Column set -> {rule: sign}: the pairs whose first match is the rule are
    the signed sum, over these sets, of the pairs that agree in all columns."""
    signed: dict[tuple[str, ...], dict[int, int]] = {}
    for i, rule in enumerate(rules):
        for size in range(i + 1):
            for earlier in combinations(rules[:i], size):
                columns = tuple(sorted({*rule, *[k for e in earlier for k in e]}))
                of_set = signed.setdefault(columns, {})
                of_set[i] = of_set.get(i, 0) + (-1) ** size
    kept = {columns: {i: n for i, n in of_set.items() if n} for columns, of_set in signed.items()}
    return {columns: of_set for columns, of_set in kept.items() if of_set}


def first_match_counts(of: Candidates) -> DataFrame:
    """(match_key, n_pairs) from the sizes of blocks alone, by inclusion and
    exclusion over the rules before: a few rows for each record, however large
    the blocks. Records with one id in common are no pair: what they add to a
    block's pairs is taken off."""
    columns = list(dict.fromkeys(k for rule in of.rules for k in rule))
    recs = of.records.where(F.col(of.uid).isNotNull()).select(
        F.col(of.uid).alias("_id"), *[comparable(of.records, c).cast("string").alias(c) for c in columns])
    again = recs.groupBy("_id").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select("_id")
    alike = [(1, recs.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).withColumn("_id", F.lit(None).cast("string"))),
             (-1, recs.join(again, "_id", "left_semi").groupBy(*columns, "_id").agg(F.count(F.lit(1)).alias("rows"))
                      .withColumn("_id", F.col("_id").cast("string")))]
    signed = _signed_sets(of.rules)
    keys = F.filter(F.array(*[F.when(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in cols]),
                                     F.struct(F.lit(at).alias("at"), F.array(*[F.col(k) for k in cols]).alias("key")))
                              for at, cols in enumerate(signed)]), lambda k: k.isNotNull())
    blocks = [profiles.select(F.inline(keys), "_id", "rows").groupBy("at", "key", "_id").agg(F.sum("rows").alias("n"))
                      .groupBy("at").agg(F.sum(F.expr("n * (n - 1) div 2") * F.lit(sign)).alias("pairs"))
              for sign, profiles in alike]
    by_rule = F.create_map(*[x for at, of_set in enumerate(signed.values())
                             for x in (F.lit(at), F.array(*[F.struct(F.lit(i).alias("match_key"), F.lit(n).alias("sign"))
                                                            for i, n in sorted(of_set.items())]))])
    return (reduce(DataFrame.unionByName, blocks).select("pairs", F.inline(F.element_at(by_rule, F.col("at"))))
            .groupBy("match_key").agg(F.sum(F.col("pairs") * F.col("sign")).alias("n_pairs")).where("n_pairs > 0"))


def blocking_rule_counts(pairs: DataFrame) -> DataFrame:
    """Candidate volume per first-matching rule."""
    of = candidates_of(pairs)
    if of is not None and len(of.rules) <= MOST_COUNTED_RULES:
        return first_match_counts(of)
    return pairs.groupBy("match_key").agg(F.count(F.lit(1)).alias("n_pairs"))


def value_pairs(of: Candidates, column: str) -> DataFrame:
    """The distinct (``<column>_l``, ``<column>_r``) of the candidate pairs, none
    missing. In a block each value stands with its first and last id: a value
    comes before another in some pair if its first id is below the other's
    last. So values are paired, not records."""
    l, r = f"{column}_l", f"{column}_r"
    found = []
    for rule in dict.fromkeys(of.rules):
        held = of.records.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in (of.uid, column, *rule)]))
        spans = materialize(held.groupBy(*dict.fromkeys([*rule, column])).agg(
            F.min(of.uid).alias("_first"), F.max(of.uid).alias("_last")), "value-spans")
        found.append(spans.where("_first < _last").select(F.col(column).alias(l), F.col(column).alias(r)).distinct())
        if column in rule:
            continue
        met = candidate_pairs(spans, LinkSettings(unique_id=column, blocking_rules=(rule,)), carry=["_first", "_last"])
        orders = F.array(F.when(F.col("_first_l") < F.col("_last_r"), F.struct(F.col(l).alias("a"), F.col(r).alias("b"))),
                         F.when(F.col("_first_r") < F.col("_last_l"), F.struct(F.col(r).alias("a"), F.col(l).alias("b"))))
        found.append(met.select(F.inline(F.filter(orders, lambda o: o.isNotNull()))).distinct().toDF(l, r))
    return reduce(DataFrame.unionByName, found).distinct()


def naive_pair_count(records: DataFrame) -> DataFrame:
    """n(n-1)/2: the comparisons without blocking, in integers (the even one of
    n and n - 1 is halved first)."""
    return records.agg(F.count(F.lit(1)).alias("n")).select(
        F.expr("CASE WHEN n % 2 = 0 THEN (n div 2) * (n - 1) ELSE n * ((n - 1) div 2) END").alias("naive_pairs"))
