"""Merkle manifest of a dataset: a root hash, and for every row a proof of it.

Method (slot pivot): the nodes of a level are numbered within their group; a
node's parent is its number divided by the fanout, its slot the remainder.
Grouping by parent, conditional aggregates spread the children into one column
for each slot; the columns joined in order and hashed are the parent. The
siblings of a child are the same columns without its own. Levels are written
to the shared folder. Paths to the root come from the top down: every parent
hands its own path, extended by the siblings, to its at most ``FANOUT``
children, so no join has a key of more rows than that however large a group is.

Rows are numbered by a range partitioning over (group, id, leaf) and the counts
of each range, so a group that holds a third of all rows is spread like any
other. The groups' roots are leaves of a further tree, in order of the group.

H is the lowercase hex SHA-256 of its inputs joined; digests enter as hex text.

Defined cases: a null value is ``-``, an empty text ``0:``; null is a group of
its own, the first; a null id comes first in its group and its row is never
tampered with; rows with one id are ordered by leaf, so rows repeated as a whole
have leaves of their own in neighbouring places; very long texts are hashed
whole; an empty table has no rows and no root; extra columns are not looked at."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import ascii_lower, stored, table
from tidemart.operators.merge import dense_index

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "array<struct<left:string,right:string>>"


def H(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its UTF-8 length, so that no two rows have the same input."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return H(*map(field, values))


def number(leaves: DataFrame) -> DataFrame:
    """``leaves`` (id, leaf, group, ... any) with grp (rank of the group, null first),
    groups (their number), n (rows of the group) and pos (place in the group)."""
    # null before any value, and the order of UTF-8 bytes
    keyed = leaves.withColumn("key", F.coalesce(F.concat(F.lit("1"), F.col("group")), F.lit("0")))
    keyed = stored(keyed.withColumn("tie", F.monotonically_increasing_id()), "merkle-leaves")
    order = ["key", "id", "leaf", "tie"]
    # the id holds the range above bit 33 and the row's place within it below
    ranged = stored(keyed.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("at", F.monotonically_increasing_id())
                    .withColumn("range", F.shiftright("at", 33)).drop("tie"), "merkle-ranged")
    parts = stored(ranged.groupBy("key", "range").agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("rows")),
                   "merkle-ranges")       # a row for each range and for each group
    before = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    groups = parts.groupBy("key").agg(F.sum("rows").alias("n"))
    total = groups.count()
    ranks = dense_index(groups, ["key"], out="grp").withColumn("groups", F.lit(total).cast("long"))
    offsets = (parts.withColumn("offset", F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("low"))
               .join(ranks, "key").select("key", "range", "offset", "grp", "groups", "n"))
    return (ranged.join(offsets, ["key", "range"]).withColumn("pos", F.col("at") + F.col("offset"))
            .drop("key", "range", "at", "offset"))


def climb(nodes: DataFrame, fanout: int = FANOUT) -> tuple[list[DataFrame], DataFrame]:
    """The levels above ``nodes`` (grp, pos, n, node; n: nodes of the group), each with
    (grp, pos, n, c0, c1, ..., node), and the (grp, node) of each group's root."""
    slots = [f"c{s}" for s in range(fanout)]
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, roots = [], [nodes.where("n = 1").select("grp", "node")]
    while most > 1:
        slot = F.pmod("pos", F.lit(fanout))
        up = (nodes.where("n > 1").groupBy("grp", F.expr(f"pos div {fanout}").alias("up"))
              .agg(F.max(F.expr(f"(n + {fanout - 1}) div {fanout}")).alias("n"),
                   *(F.max(F.when(slot == s, F.col("node"))).alias(c) for s, c in enumerate(slots)))
              .withColumnRenamed("up", "pos"))
        nodes = stored(up.withColumn("node", H(F.concat_ws("", *slots))), "merkle-level")
        levels.append(nodes)
        roots.append(nodes.where("n = 1").select("grp", "node"))
        most = -(-most // fanout)
    return levels, reduce(DataFrame.unionByName, roots)


def siblings(fanout: int = FANOUT) -> Column:
    """Of a parent's row: for each slot, what stands left and right of it."""
    def joined(slots):
        return F.concat_ws("", *(f"c{s}" for s in slots)) if slots else F.lit("")
    return F.array(*(F.struct(joined(range(s)).alias("left"), joined(range(s + 1, fanout)).alias("right"))
                     for s in range(fanout)))


def paths(levels: list[DataFrame], tops: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(grp, pos, siblings, path, and the other columns of ``tops``) for every node of
    the lowest level: ``path`` leads from that node to the root, ``tops`` (grp,
    path, ...) has what is above the roots of the groups."""
    extra = [c for c in tops.columns if c not in ("grp", "path")]
    known = None
    for level in reversed(levels):
        here = level.where("n = 1").select("grp", "pos").join(tops, "grp")
        here = here if known is None else here.unionByName(known)
        here = level.drop("n", "node").join(here, ["grp", "pos"])
        beside = F.posexplode(F.filter(F.arrays_zip(F.array(*(f"c{s}" for s in range(fanout))).alias("node"),
                                                    siblings(fanout).alias("beside")),
                                       lambda x: x["node"].isNotNull()))
        known = (here.select("grp", "pos", "path", *extra, beside.alias("slot", "x"))
                 .select("grp", (F.col("pos") * fanout + F.col("slot")).alias("pos"), *extra,
                         F.concat(F.array(F.col("x.beside")), F.col("path")).alias("path")))
    return here.select("grp", "pos", siblings(fanout).alias("siblings"), "path", *extra)


@dataclass(frozen=True)
class Manifest:
    """``leaves``: id, leaf, grp, groups, n, pos and what else came with them; ``levels``
    of the groups' trees, ``tops``: (grp, path, subroot, root) of the groups."""

    leaves: DataFrame
    levels: list[DataFrame]
    tops: DataFrame
    fanout: int = FANOUT


def build(leaves: DataFrame, fanout: int = FANOUT) -> Manifest:
    """The trees over ``leaves`` (id, leaf, group, and any other columns)."""
    numbered = stored(number(leaves), "merkle-numbered")
    levels, roots = climb(numbered.select("grp", "pos", "n", F.col("leaf").alias("node")), fanout)
    roots = stored(roots.join(numbered.where("pos = 0").select("grp", "groups"), "grp"), "merkle-roots")
    nodes = roots.select(F.lit(0).cast("long").alias("grp"), F.col("grp").alias("pos"), F.col("groups").alias("n"), "node")
    upper, root = climb(nodes, fanout)
    none = F.from_json(F.lit("[]"), STEP)
    above = root.select("grp", none.alias("path"), F.col("node").alias("root"))
    tops = roots.select(F.col("grp").alias("pos"), F.col("node").alias("subroot"))
    if upper:
        known = paths(upper, above, fanout)
        tops = (tops.withColumn("up", F.expr(f"pos div {fanout}"))
                .join(known.select(F.col("pos").alias("up"), "siblings", "path", "root"), "up")
                .select(F.col("pos").alias("grp"), "subroot", "root", _extended("siblings", "path", "pos", fanout).alias("path")))
    else:
        tops = tops.withColumnRenamed("pos", "grp").join(above, "grp")
    return Manifest(numbered, levels, stored(tops, "merkle-tops"), fanout)


def _extended(beside: str, path: str, pos: str, fanout: int) -> Column:
    mine = F.element_at(F.col(beside), (F.pmod(F.col(pos), F.lit(fanout)) + 1).cast("int"))
    return F.concat(F.array(mine), F.col(path))


def prove(m: Manifest) -> DataFrame:
    """The leaves with subroot, root and path: what stands left and right of the
    leaf and of every node above it, up to the root."""
    cols = [c for c in m.leaves.columns if c not in ("grp", "groups", "n", "pos")]
    found = m.leaves.where("n = 1").join(m.tops, "grp").select(*cols, "subroot", "root", "path")
    if m.levels:
        known = paths(m.levels, m.tops, m.fanout).withColumnRenamed("pos", "up")
        many = (m.leaves.where("n > 1").withColumn("up", F.expr(f"pos div {m.fanout}")).join(known, ["grp", "up"])
                .select(*cols, "subroot", "root", _extended("siblings", "path", "pos", m.fanout).alias("path")))
        found = many.unionByName(found)
    return found


def proof_digest(path: str = "path") -> Column:
    """H of all siblings of a path, level by level."""
    return H(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""))


def fold(start: Column, path: str = "path") -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(F.col(path), start, lambda node, x: H(x["left"], node, x["right"]))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    values = {c: F.col(c) for c in FIELDS}
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0
    changed = leaf([*(values | {"text": ascii_lower(F.col("text"))}).values()])
    leaves = docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("group"), leaf([*values.values()]).alias("leaf"),
                         F.when(tampered, changed).alias("other"))
    rows = prove(build(leaves)).withColumn("folded_root", fold(F.coalesce("other", "leaf")))
    return rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest().alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _tree_sql(name: str, levels: int) -> str:
    """Levels of a tree in SQL: <name>0 .. with (grp, pos, n, node), and their runs."""
    out = []
    for k in range(levels):
        out.append(f"""{name}_run{k} AS (
  SELECT grp, pos // 8 AS pos, max(n) AS n, list(node ORDER BY pos) AS nodes FROM {name}{k} GROUP BY grp, pos // 8),
{name}{k + 1} AS (
  SELECT grp, pos, (n + 7) // 8 AS n, CASE WHEN n = 1 THEN nodes[1] ELSE sha256(array_to_string(nodes, '')) END AS node
  FROM {name}_run{k})""")
    return ",\n".join(out)


def _fold_sql(levels: int) -> str:
    """Each leaf's way up: acc from the (tampered) leaf, all siblings so far."""
    out, last = [], "f0"
    for tree, grp, pos in (("t", "f.grp", "f.pos"), ("u", "0", "f.grp")):
        for k in range(levels):
            run = f"{tree}_run{k}"
            slot = f"({pos} // {8 ** k} % 8)"
            left, right = f"array_to_string(nodes[1:{slot}], '')", f"array_to_string(nodes[{slot} + 2:], '')"
            name = f"f_{tree}{k}"
            out.append(f"""{name} AS (
  SELECT f.doc_id, f.leaf, f.grp, f.pos,
         CASE WHEN r.n = 1 THEN f.acc ELSE sha256({left} || f.acc || {right}) END AS acc,
         CASE WHEN r.n = 1 THEN f.proof ELSE f.proof || {left} || {right} END AS proof
  FROM {last} f JOIN {run} r ON r.grp = {grp} AND r.pos = {pos} // {8 ** (k + 1)})""")
            last = name
    return ",\n".join(out)


SQL_LEVELS = 7      # the statement holds for up to 8^7 rows in a group, and as many groups
_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LOWERED = f"translate(text, '{'ABCDEFGHIJKLMNOPQRSTUVWXYZ'}', '{'abcdefghijklmnopqrstuvwxyz'}')"
_CRC = """xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""
OP11_SQL = f"""
WITH leaves AS (
  SELECT doc_id, lang, sha256({' || '.join(_FIELD.format(c) for c in FIELDS)}) AS leaf,
         CASE WHEN {_CRC} % 3 = 0
              THEN sha256({' || '.join(_FIELD.format(c if c != 'text' else _LOWERED) for c in FIELDS)}) END AS other
  FROM documents),
f0 AS (
  SELECT doc_id, leaf, coalesce(other, leaf) AS acc, '' AS proof, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS grp,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM leaves),
t0 AS (SELECT grp, pos, count(*) OVER (PARTITION BY grp) AS n, leaf AS node FROM f0),
{_tree_sql("t", SQL_LEVELS)},
u0 AS (SELECT 0 AS grp, grp AS pos, count(*) OVER () AS n, node FROM t{SQL_LEVELS}),
{_tree_sql("u", SQL_LEVELS)},
{_fold_sql(SQL_LEVELS)}
SELECT f.doc_id, f.leaf, s.node AS subroot, r.node AS root, sha256(f.proof) AS proof_sha256, f.acc AS folded_root,
       f.acc = r.node AS verified
FROM f_u{SQL_LEVELS - 1} f JOIN t{SQL_LEVELS} s ON s.grp = f.grp JOIN u{SQL_LEVELS} r ON true
"""
