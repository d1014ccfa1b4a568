"""SimHash near-dedup by anchor-point covering.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, 3-word shingles
with repeats (fewer words: the whole sequence is the one shingle; no words:
fingerprint 0), XXH64 with seed 42 of each; a bit is 1 if over half the hashes
have it. Fingerprints that differ in 2 bits or fewer are linked, and links are
followed to whole components.

Method: the anchors are the words of a covering code. The low 46 bits are read
as two words of the perfect binary Golay code (23 bits, covering radius 3, so
2^24 anchors). A fingerprint's home is the anchor within the radius of each
half; its replicas go to every anchor within radius plus threshold, the
threshold being shared between the halves (about 64). If two fingerprints are
linked, the one's home is among the other's replicas, so comparing each
anchor's homes with its replicas finds every link once, and exactly.

Crowded anchors (many different fingerprints with one home) are not compared
in one place: their members go to the 65 points within one bit. Linked
fingerprints share such a point, at most 65 fingerprints can meet at one, and
all that meet are linked, so every point links its members to the smallest.

Links and components stay in DataFrames: components are found by minimum
labels over links with pointer jumping, each round written to the shared
folder. A fingerprint has at most 2,080 possible neighbours, so no key of the
link table is hot. Copies are counted per (fingerprint, salt) before and after.

Defined cases: null text counts as empty; empty texts have fingerprint 0 and
form a group; a null doc_id is never the smallest unless its group has no
other; repeated rows share fingerprint and component (``drop_near`` keeps one);
an empty table gives an empty result; extra columns are not looked at."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import once_each, rows_of, stored, table, utf8_rows

SHINGLE = 3
SEED = 42
THRESHOLD = 2
SALTS = 64
CROWD = 256         # homes at one anchor from which its members meet at points instead
_FP = T.StructField("__fp", T.LongType())
_PIECE = 65536      # shingles summed at a time


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    import numpy as np
    from xxhash import xxh64_intdigest
    words = text.lower().split()  # on bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        return xxh64_intdigest(b" ".join(words), SEED)
    n = len(words) - shingle + 1
    join = b" ".join
    hashes = np.fromiter((xxh64_intdigest(join(t), SEED)
                          for t in zip(*(words[k:] for k in range(shingle)), strict=False)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _PIECE):
        part = hashes[i:i + _PIECE]
        ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprint_batches(at: int, keep: list[int]):
    def batches(it):
        import numpy as np
        import pyarrow as pa
        for b in it:
            fp = np.fromiter(map(simhash, utf8_rows(b.column(at))), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), pa.array(fp.view(np.int64))],
                                             names=[*(b.schema.names[k] for k in keep), "__fp"])
    return batches


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) for every row; fp is the fingerprint as a signed long."""
    rows = rows_of(docs)
    schema = T.StructType([rows.schema["doc_id"], _FP])
    return rows.mapInArrow(_fingerprint_batches(1, [0]), schema).withColumnRenamed("__fp", "fp")


# --- the covering code -------------------------------------------------------

_BITS, _RADIUS, _POLY = 23, 3, 0xC75    # the binary Golay code and its generator


@lru_cache(1)
def _cosets():
    """Tables of the Golay code: the syndromes of the low 12 and high 11 bits, and
    for every syndrome the error patterns of weight up to radius + threshold,
    lightest first, with the first place of each excess over the radius."""
    import numpy as np
    unit = []
    for k in range(_BITS):
        x = 1 << k
        for top in range(_BITS - 1, 10, -1):
            if x >> top & 1:
                x ^= _POLY << (top - 11)
        unit.append(x)

    def syndromes(first: int, bits: int):
        out = np.zeros(1 << bits, np.uint16)
        for k in range(bits):
            out[1 << k:2 << k] = out[:1 << k] ^ unit[first + k]
        return out

    low, high = syndromes(0, 12), syndromes(12, 11)
    patterns = np.array([sum(1 << k for k in c) for w in range(_RADIUS + THRESHOLD + 1)
                         for c in combinations(range(_BITS), w)], np.uint64)
    syn = low[patterns & 0xFFF] ^ high[patterns >> 12]
    excess = np.maximum(np.bitwise_count(patterns).astype(np.int64) - _RADIUS, 0)
    order = np.lexsort((excess, syn))
    starts = np.searchsorted(syn[order].astype(np.int64) * 8 + excess[order],
                             np.arange(2048)[:, None] * 8 + np.arange(THRESHOLD + 2)[None, :])
    return low, high, patterns[order], starts


def anchors(fp, homes_only: bool = False):
    """Anchors of an array of fingerprints (uint64): index of the fingerprint,
    anchor, whether it is the home."""
    import numpy as np
    low, high, patterns, starts = _cosets()
    mask = np.uint64((1 << _BITS) - 1)
    halves = [fp & mask, (fp >> np.uint64(_BITS)) & mask]
    syn = [(low[h & np.uint64(0xFFF)] ^ high[h >> np.uint64(12)]).astype(np.int64) for h in halves]
    index, anchor, home = [], [], []
    for ea in range(1 if homes_only else THRESHOLD + 1):
        for eb in range(1 if homes_only else THRESHOLD + 1 - ea):
            first = [starts[syn[0], ea], starts[syn[1], eb]]
            count = [starts[syn[0], ea + 1] - first[0], starts[syn[1], eb + 1] - first[1]]
            total = count[0] * count[1]
            i = np.repeat(np.arange(len(fp)), total)
            within = np.arange(len(i)) - np.repeat(np.cumsum(total) - total, total)
            a = halves[0][i] ^ patterns[first[0][i] + within // count[1][i]]
            b = halves[1][i] ^ patterns[first[1][i] + within % count[1][i]]
            index.append(i)
            anchor.append(a | b << np.uint64(_BITS))
            home.append(np.full(len(i), ea == 0 and eb == 0))
    return np.concatenate(index), np.concatenate(anchor), np.concatenate(home)


def _anchor_batches(homes_only: bool):
    def batches(it):
        import numpy as np
        import pyarrow as pa
        for b in it:
            all_fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k in range(0, len(all_fp), 4096):
                fp = all_fp[k:k + 4096]
                i, anchor, _ = anchors(fp, homes_only)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(fp[i].view(np.int64))],
                                                 names=["anchor", "fp"])
    return batches


def _point_batches(it):
    """Every fingerprint at the 65 points within one bit of it."""
    import numpy as np
    import pyarrow as pa
    flips = np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64)])
    for b in it:
        all_fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for k in range(0, len(all_fp), 4096):
            fp = all_fp[k:k + 4096]
            yield pa.RecordBatch.from_arrays([pa.array((fp[:, None] ^ flips).ravel().view(np.int64)),
                                              pa.array(np.repeat(fp, 65).view(np.int64))], names=["point", "fp"])


def links(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(a, b): all pairs of different fingerprints of ``fps`` (distinct ``fp``) that
    differ in at most THRESHOLD bits; at crowded anchors a chain of such pairs for each."""
    only = fps.select("fp")
    visits = only.mapInArrow(_anchor_batches(False), "anchor bigint, fp bigint")
    homes = only.mapInArrow(_anchor_batches(True), "anchor bigint, fp bigint")
    crowded = stored(homes.groupBy("anchor").count().where(F.col("count") > crowd).select("anchor"),
                     "simhash-crowded")
    some = not crowded.isEmpty()
    if some:
        homes = homes.join(crowded, "anchor", "left_anti")
    v, h = visits.alias("v").hint("merge"), homes.alias("h").hint("merge")
    found = (v.join(h, (F.col("v.anchor") == F.col("h.anchor")) & (F.col("h.fp") < F.col("v.fp"))
                    & (F.bit_count(F.col("v.fp").bitwiseXOR(F.col("h.fp"))) <= THRESHOLD))
             .select(F.col("h.fp").alias("a"), F.col("v.fp").alias("b")))
    if some:
        members = visits.join(crowded, "anchor", "left_semi").select("fp").distinct()
        met = (members.mapInArrow(_point_batches, "point bigint, fp bigint")
               .groupBy("point").agg(F.collect_list("fp").alias("all")))  # at most 65 fingerprints
        star = (met.where(F.size("all") > 1)
                .select(F.array_min("all").alias("a"), F.explode("all").alias("b"))
                .where("a <> b").distinct())
        found = found.unionByName(star)
    return found


def component_labels(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, label) for every node that has a link. ``nodes`` has (fp, mark), the
    mark being an orderable struct that ends in ``fp``; the label is the smallest
    mark of the component."""
    pairs = stored(pairs, "simhash-links")
    if pairs.isEmpty():
        return nodes.limit(0).select(F.col("fp").alias("node"), F.col("mark").alias("label"))
    ends = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = stored(ends.unionByName(ends.select("a", F.col("a").alias("b"))).distinct(), "simhash-near")
    labels = stored(nodes.join(near.select(F.col("a").alias("fp")).distinct(), "fp")
                    .select(F.col("fp").alias("node"), F.col("mark").alias("label")), "simhash-labels")
    while True:
        to = labels.select(F.col("node").alias("root"), F.col("label").alias("jump"))
        jumped = (labels.join(to, F.col("label.fp") == F.col("root"))
                  .select("node", F.col("jump").alias("label"), F.col("label").alias("before")))
        hooked = (near.join(jumped, near["b"] == jumped["node"])
                  .groupBy("a").agg(F.min("label").alias("label"),
                                    F.max(F.when(F.col("a") == F.col("b"), F.col("before"))).alias("before")))
        state = stored(hooked.withColumnRenamed("a", "node"), "simhash-labels")
        labels = state.select("node", "label")
        if state.where("label <> before").isEmpty():
            return labels


def near_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id (smallest doc_id
    reachable), best_fp (the fingerprint of that document)."""
    rows = stored(fingerprints(docs).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")),
                  "simhash-rows")
    parts = rows.groupBy("fp", "salt").agg(F.min("doc_id").alias("m"))
    nodes = stored(parts.groupBy("fp").agg(F.min("m").alias("m"), F.collect_list("salt").alias("salts"))
                   .select("fp", "salts", F.struct(F.col("m").isNull().alias("none"), F.col("m").alias("id"),
                                                   F.col("fp")).alias("mark")), "simhash-nodes")
    labels = component_labels(nodes.select("fp", "mark"), links(nodes))
    decided = (nodes.join(labels, nodes["fp"] == labels["node"], "left")
               .select("fp", F.explode("salts").alias("salt"), F.coalesce("label", "mark").alias("best"))
               .select("fp", "salt", F.col("best.id").alias("component_id"), F.col("best.fp").alias("best_fp")))
    return rows.join(decided, ["fp", "salt"]).select("doc_id", "fp", "component_id", "best_fp")


def drop_near(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: the smallest doc_id."""
    kept = (near_dedup(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("fp") == F.col("best_fp")))
            .select("doc_id", F.col("fp").alias("__fp")))
    at = docs.columns.index("text")
    mine = docs.mapInArrow(_fingerprint_batches(at, list(range(len(docs.columns)))),
                           T.StructType([*docs.schema.fields, _FP]))
    return once_each(mine, kept, ["doc_id", "__fp"]).drop("__fp")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (near_dedup(table(spark, sf_dir, "documents"))
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
