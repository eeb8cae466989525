"""Merkle manifest of a table: one tree per language, one over the languages' roots, a proof per row.

A level is a table of nodes (group, place, count, digest). It is joined with itself on computed places:
a node asks for the other slots of its run of ``ARITY``, each slot at a fixed offset, and the equi-join
returns their digests. Rows in slot zero then hold the whole run and emit the parent. Nothing gathers a
group: a language may own most rows, places come from a range sort, and a run has ``ARITY`` rows.
Siblings go down again from the root, one join per level, so that each row ends with its whole path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.llm.common import CRC_STEPS_SQL, bucket_of, crc32_sql, same_row, stored
from secflow.plans.physical import broadcast_if_bounded

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PART_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def lowered(text: Column) -> Column:
    """A-Z in lower case; text without other letters takes the faster function."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def _leaf(fields: list[Column]) -> Column:
    """Digest of the fields, each as its UTF-8 length, a colon and its text, or ``-`` for null."""
    texts = [c.cast("string") for c in fields]
    return digest(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def numbered(df: DataFrame, order: list[str], number: str) -> DataFrame:
    """Add the place of each row in ``order`` (from 0, nulls first), from a range sort over all partitions.

    The sorted rows are stored, which fixes their places when a task is repeated.
    """
    placed = stored(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("_part", F.shiftright("_place", _PART_BITS))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    # one row per partition of the sort
    before = sizes.selectExpr(
        "_part AS _of", "coalesce(sum(_rows) OVER (ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _base")
    local = F.col("_place") - F.shiftleft("_part", _PART_BITS)
    return placed.join(F.broadcast(before), F.col("_part") == F.col("_of")).withColumn(
        number, F.col("_base") + local).drop("_place", "_part", "_of", "_base")


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Add ``siblings``: the digests of the other nodes of the run, left to right; null above a root."""
    run = F.col("idx") - F.col("idx") % arity
    asked = nodes.where("n > 1").select("grp", "idx", "n", F.explode(F.sequence(F.lit(1), F.lit(arity - 1))).alias("shift"))
    asked = asked.select("grp", "idx", "n", (run + (F.col("idx") + F.col("shift")) % arity).alias("sibling")).where("sibling < n")
    others = nodes.select("grp", F.col("idx").alias("sibling"), F.col("d").alias("other"))
    found = asked.join(others, ["grp", "sibling"]).groupBy("grp", "idx").agg(
        F.sort_array(F.collect_list(F.struct("sibling", "other"))).alias("found"))  # at most arity - 1
    kept = nodes.join(found, ["grp", "idx"], "left")
    none = F.array().cast("array<string>")
    return kept.withColumn("siblings", F.when(F.col("n") > 1, F.coalesce(F.col("found.other"), none))).drop("found")


def _parents(level: DataFrame, arity: int) -> DataFrame:
    """Rows in slot zero emit the run's digest one level up; a root stays as it is."""
    whole = digest(F.concat(F.col("d"), F.array_join("siblings", "")))
    rows = level.where(F.col("idx") % arity == 0)
    return rows.select(
        "grp", F.expr(f"idx DIV {arity}").alias("idx"), F.expr(f"(n + {arity - 1}) DIV {arity}").alias("n"),
        F.when(F.col("n") > 1, whole).otherwise(F.col("d")).alias("d"))


def _tree(nodes: DataFrame, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """The levels of all groups' trees with siblings, leaves first, and the groups' roots."""
    levels = []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        levels.append(stored(_with_siblings(nodes, arity), "tree-level"))
        nodes = _parents(levels[-1], arity)
        most = -(-most // arity)
    return levels, nodes


def _down(levels: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """Leaves of the trees with the paths of ``tops`` (grp, idx, steps, more), their own steps before them."""
    paths = tops
    carried = [c for c in tops.columns if c not in ("grp", "idx", "steps")]
    for level in reversed(levels):
        above = paths.select(
            F.col("grp").alias("_grp"), F.col("idx").alias("_idx"), F.col("steps").alias("_steps"), *carried)
        joined = level.join(above, (F.col("grp") == F.col("_grp")) & (F.expr(f"idx DIV {arity}") == F.col("_idx")))
        step = F.struct((F.col("idx") % arity).cast("int").alias("slot"), F.col("siblings"))
        paths = joined.withColumn(
            "steps", F.when(F.col("n") > 1, F.concat(F.array(step), F.col("_steps"))).otherwise(F.col("_steps"))).drop(
            "_grp", "_idx", "_steps")
    return paths


_STEPS = "array<struct<slot:int,siblings:array<string>>>"


def _folded(start: str) -> Column:
    """The root that a leaf's digest and its path lead to."""
    return F.expr(
        f"aggregate(steps, {start}, (d, s) -> sha2(cast(concat(array_join(slice(s.siblings, 1, s.slot), ''), d, "
        "array_join(slice(s.siblings, s.slot + 1, size(s.siblings)), '')) AS binary), 256))")


def manifest(docs: DataFrame, arity: int = ARITY, tampered_every: int = 3) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    A null field is ``-`` in a leaf, an empty one ``0:``, texts of any length enter whole. Leaves of a
    language ascend by doc_id, nulls first, rows that share an id by digest; a null language is one of
    its own and the first. Repeated rows are leaves of their own. Other columns are ignored; a table
    without rows has no root and gives no rows. Rows whose id's crc32 is divisible by
    ``tampered_every`` are verified with A-Z of their text in lower case; rows without an id are not tampered.
    """
    fields = [F.col(c) for c in FIELDS]
    chosen = F.col("doc_id").isNotNull() & (bucket_of(F.col("doc_id"), tampered_every) == 0)
    leaves = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), _leaf(fields).alias("d"),
        F.when(chosen, _leaf([*fields[:-1], lowered(F.col("text").cast("string"))])).alias("changed")), "leaves")
    placed = numbered(leaves, ["lang", "doc_id", "d"], "place")
    langs = stored(placed.groupBy("lang").agg(F.min("place").alias("first"), F.count("*").alias("n")), "langs")
    groups = numbered(langs, ["lang"], "grp")
    n_groups = groups.count()
    nodes = same_row(placed, broadcast_if_bounded(groups), ["lang"], "inner").select(
        "grp", (F.col("place") - F.col("first")).alias("idx"), "n", "d", "doc_id", "changed")
    nodes = stored(nodes, "nodes")
    levels, subroots = _tree(nodes.select("grp", "idx", "n", "d"), arity)
    subroots = stored(subroots, "subroots")
    top = subroots.select(
        F.lit(0).cast("long").alias("grp"), F.col("grp").alias("idx"), F.lit(n_groups).cast("long").alias("n"), "d")
    top_levels, root = _tree(top, arity)
    root = root.select("grp", "idx", F.col("d").alias("root"), F.array().cast(_STEPS).alias("steps"))
    heads = _down(top_levels, root, arity)
    if not top_levels:  # one language: its root is the root
        heads = heads.withColumn("d", F.col("root"))
    heads = heads.select(
        F.col("idx").alias("grp"), F.lit(0).cast("long").alias("idx"), F.col("d").alias("subroot"), "root", "steps")
    if levels:
        below = _down(levels[1:], heads, arity).select("grp", "idx", "subroot", "root", "steps")
        rows = levels[0].join(nodes.select("grp", "idx", "doc_id", "changed"), ["grp", "idx"])
        paths = _down([rows], below, arity)
    else:
        paths = nodes.join(heads, ["grp", "idx"])
    proof = digest(F.expr("array_join(flatten(transform(steps, s -> s.siblings)), '')"))
    checked = paths.select(
        "doc_id", F.col("d").alias("leaf"), "subroot", "root", proof.alias("proof_sha256"),
        _folded("coalesce(changed, d)").alias("folded_root"))
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))


def _leaf_sql(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields) + ")"


#: The same by recursion over levels. A node's group is its language's rank; the languages' own tree is group -1.
SQL = f"""
WITH RECURSIVE crc AS ({CRC_STEPS_SQL}),
ranked AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS grp FROM documents),
leaves AS (
  SELECT grp, doc_id, {_leaf_sql('text')} AS leaf,
    CASE WHEN {crc32_sql("list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)")} % 3 = 0
      THEN {_leaf_sql(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS changed FROM ranked, crc),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY grp) AS n FROM leaves),
up AS (
  SELECT grp, 0 AS lev, idx, n, leaf AS d FROM placed
  UNION ALL
  SELECT grp, lev + 1, idx // 8, any_value((n + 7) // 8), sha256(string_agg(d, '' ORDER BY idx))
  FROM up WHERE n > 1 GROUP BY grp, lev, idx // 8),
subroots AS (SELECT grp, lev AS top, d AS subroot FROM up WHERE n = 1),
above AS (
  SELECT 0 AS lev, grp AS idx, (SELECT count(*) FROM subroots) AS n, subroot AS d FROM subroots
  UNION ALL
  SELECT lev + 1, idx // 8, any_value((n + 7) // 8), sha256(string_agg(d, '' ORDER BY idx))
  FROM above WHERE n > 1 GROUP BY lev, idx // 8),
nodes AS (
  SELECT grp, lev, idx, d FROM up WHERE n > 1 UNION ALL SELECT -1, lev, idx, d FROM above WHERE n > 1),
steps AS (
  SELECT doc_id, leaf, subroot, changed, lev AS k, placed.grp AS tree, lev AS lev, placed.idx // (8 ** lev)::BIGINT AS own
  FROM placed JOIN subroots USING (grp), range((SELECT max(lev) + 1 FROM up)) r(lev) WHERE lev < top
  UNION ALL
  SELECT doc_id, leaf, subroot, changed, top + lev, -1, lev, placed.grp // (8 ** lev)::BIGINT
  FROM placed JOIN subroots USING (grp), range((SELECT max(lev) + 1 FROM above)) r(lev)
  WHERE lev < (SELECT max(lev) FROM above)),
paths AS (
  SELECT doc_id, leaf, subroot, changed, k,
    coalesce(string_agg(d, '' ORDER BY idx) FILTER (WHERE idx < own), '') AS before,
    coalesce(string_agg(d, '' ORDER BY idx) FILTER (WHERE idx > own), '') AS after
  FROM steps JOIN nodes ON nodes.grp = tree AND nodes.lev = steps.lev AND idx // 8 = own // 8
  GROUP BY ALL),
whole AS (
  SELECT doc_id, leaf, subroot, changed, list(before ORDER BY k) AS befores, list(after ORDER BY k) AS afters,
    string_agg(before || after, '' ORDER BY k) AS siblings FROM paths GROUP BY ALL
  UNION ALL SELECT doc_id, leaf, subroot, changed, [], [], '' FROM placed JOIN subroots USING (grp)
  WHERE top = 0 AND (SELECT count(*) FROM subroots) = 1),
fold AS (
  SELECT doc_id, leaf, subroot, befores, afters, siblings, 1 AS k, coalesce(changed, leaf) AS d FROM whole
  UNION ALL
  SELECT doc_id, leaf, subroot, befores, afters, siblings, k + 1, sha256(befores[k] || d || afters[k])
  FROM fold WHERE k <= len(befores))
SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, d AS folded_root, d = root AS verified
FROM fold, (SELECT d AS root FROM above WHERE n = 1) WHERE k = len(befores) + 1
"""
