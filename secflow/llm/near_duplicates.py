"""Near-duplicates of weighted word shingles: ProbMinHash, banding, verification.

Each shingle of a text sends exponential arrivals at the rate of its weight; every arrival falls on
one of ``M`` components, and a component keeps the shingle that arrives first. A shingle stops once
its next arrival comes after every component's first (early termination). Two texts agree in a
component with the probability Jaccard similarity of their weighted shingles.

Equal texts are one node, found by digest. Nodes that share a band meet in a bucket; first its members
are compared with a few pivots, and the Jaccard similarity of the shingle sets is computed exactly.
The pivot is the member that meets most others. Members that stay in different components, linked to a
pivot or not, then go through an exact join of sets by prefixes: no bucket is capped and no pair of
one is left out, save pairs already connected. Verified pairs form components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.llm.common import hand_back, per_process, stored
from secflow.plans.physical import broadcast_if_bounded

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 40, 6  # a pair of similarity 0.8 shares no band with probability 5e-6
M = BANDS * ROWS
BATCH_BYTES = 700_000
PIVOTS = 2  # members of a bucket that are compared with all its others, one after the other
CELLS = 1 << 20  # counters of shingles, by which the rarer come first
BLOCK = 256  # holders of one shingle that a group of the join has on one side

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    held = per_process("shingle-powers", dict)
    if "p" not in held or len(held["p"]) < n:
        size = max(n, BATCH_BYTES * 2)
        for name, b in (("p", base), ("q", pow(base, -1, 1 << 64))):
            steps = np.full(size, b, _U)
            steps[0] = 1
            held[name] = np.cumprod(steps, dtype=_U)
    return held["p"], held["q"]


def shingles(texts: list[bytes], length: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, count) of the distinct shingles of many texts, sorted by both.

    Words are runs other than ASCII white space; a text of fewer words than ``length`` is one shingle,
    one without words has none.
    """
    data = b" ".join(texts) + b" "
    raw = np.frombuffer(data, np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate(([True], space)).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(0, np.int64)
    power, inverse = _powers(len(raw))
    sums = np.concatenate((np.zeros(1, _U), np.cumsum((raw.astype(_U) + _U(1)) * power[:len(raw)], dtype=_U)))
    words = _mix((sums[ends] - sums[starts]) * inverse[starts])
    bounds = np.cumsum([len(t) + 1 for t in texts])
    owner = np.searchsorted(bounds, starts, side="right")
    count = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(count) - count
    place = np.arange(len(words)) - first[owner]
    # runs of `length` words, or the whole of a shorter text
    out = np.zeros(len(words), _U)
    last = first[owner] + count[owner]
    for k in range(length):
        at = np.arange(len(words)) + k
        inside = at < last
        out += np.where(inside, _mix(words[np.minimum(at, len(words) - 1)] + _U(2 * k + 1)), _U(0))
    keep = (place + length <= count[owner]) | (place == 0)
    owner, out = owner[keep], _mix(out[keep])
    order = np.lexsort((out, owner))
    owner, out = owner[order], out[order]
    new = np.ones(len(out), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (out[1:] != out[:-1])
    at = np.flatnonzero(new)
    return owner[at], out[at], np.diff(np.concatenate((at, [len(out)])))


def signatures(owner: np.ndarray, hashes: np.ndarray, weights: np.ndarray, texts: int, m: int = M) -> np.ndarray:
    """ProbMinHash: for each text and component the 32-bit name of the shingle that arrives first."""
    best = np.full(texts * m, np.iinfo(np.uint64).max, _U)
    size = np.bincount(owner, minlength=texts)
    for low, high, at_once in ((1, 8, 256), (8, 64, 32), (64, 512, 4), (512, 1 << 62, 1)):
        mine = (size[owner] >= low) & (size[owner] < high)
        who, what, rate = owner[mine], hashes[mine], weights[mine].astype(np.float64)
        clock, turn = np.zeros(len(who)), 0
        while len(who):
            steps = (np.arange(turn, turn + at_once, dtype=_U) * _U(0x9E3779B97F4A7C15))[None, :]
            draw = _mix(what[:, None] + steps)
            uniform = ((draw >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53
            arrival = clock[:, None] + np.cumsum(-np.log(uniform), axis=1) / rate[:, None]
            component = (_mix(draw + _U(1)) % _U(m)).astype(np.int64)
            packed = (arrival.astype(np.float32).view(np.uint32).astype(_U) << _U(32)) | (what >> _U(32))[:, None]
            np.minimum.at(best, (who[:, None] * m + component).ravel(), packed.ravel())
            clock, turn = arrival[:, -1], turn + at_once
            latest = best.reshape(texts, m).max(axis=1)[who]
            going = (clock.astype(np.float32).view(np.uint32).astype(_U) << _U(32)) <= latest
            who, what, rate, clock = who[going], what[going], rate[going], clock[going]
    return (best & _U(0xFFFFFFFF)).reshape(texts, m)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    texts, m = signature.shape
    rows = m // bands
    parts = signature.reshape(texts, bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=_U), (texts, bands)).copy()
    for k in range(rows):
        key = _mix(key * _U(0x100000001B3) + parts[:, :, k] + _U(1))
    return key.view(np.int64)


def _groups(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for k, n in enumerate(sizes):
        if held and held + n > limit:
            yield start, k
            start, held = k, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def digest(text: str = "text") -> Column:
    """Name of a text; null texts have none in common with others."""
    return F.md5(F.col(text))


def _nodes(docs: DataFrame) -> DataFrame:
    """One row per different text: th, rep (least id, null last), n_rows, n (distinct shingles), bands."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_pylist()
            for a, b in _groups(sizes, BATCH_BYTES):
                texts = _texts(batch.column(2).slice(a, b - a))
                owner, hashes, counts = shingles(texts)
                n = np.bincount(owner, minlength=len(texts))
                keys = band_keys(signatures(owner, hashes, 1 + np.log(counts), len(texts)))
                offsets = pa.array(np.arange(len(texts) + 1) * BANDS, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(keys.ravel(), pa.int64()))],
                    names=["th", "doc_id", "n", "bands"])
        hand_back()

    rows = docs.where(F.col("text").isNotNull()).select(
        digest().alias("th"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = rows.mapInArrow(sign, "th string, doc_id long, n long, bands array<long>")
    return signed.groupBy("th").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("n_rows"), F.first("n").alias("n"), F.first("bands").alias("bands"))


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """th and shingles (the different 32-bit names) of the wanted texts; ``wanted`` has each th once."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for a, b in _groups(sizes, BATCH_BYTES):
                texts = _texts(batch.column(1).slice(a, b - a))
                owner, hashes, _ = shingles(texts)
                names = (hashes >> _U(32)).astype(np.uint32)
                new = np.ones(len(names), bool)
                new[1:] = (owner[1:] != owner[:-1]) | (names[1:] != names[:-1])
                cuts = np.searchsorted(owner[new], np.arange(len(texts) + 1)).astype(np.int32)
                values = pa.ListArray.from_arrays(pa.array(cuts), pa.array(names[new].view(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), values], names=["th", "shingles"])
        hand_back()

    rows = docs.where(F.col("text").isNotNull()).select(digest().alias("th"), "text")
    named = rows.join(broadcast_if_bounded(wanted), "th", "left_semi")
    return named.mapInArrow(sets, "th string, shingles array<int>").dropDuplicates(["th"])


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) whose shingle sets have at least the similarity; sets are compared row by row in the join."""
    left = sets.select(F.col("th").alias("_a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("th").alias("_b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, F.col("a") == F.col("_a")).join(right, F.col("b") == F.col("_b"))
    common = F.size(F.array_intersect("sa", "sb"))
    enough = common * (1 + similarity) >= similarity * (F.size("sa") + F.size("sb")) - 1e-9
    return both.where(enough).select("a", "b")


def links(docs: DataFrame, nodes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Verified pairs (a, b) of different texts; ``nodes`` has th, n and bands.

    The pairs connect all texts of a bucket that similar texts connect; pairs already connected are not compared.
    """
    members = nodes.where("n > 0").select("th", "n", F.posexplode("bands").alias("band", "key"))
    shared = members.groupBy("band", "key").agg(F.count("*").alias("c")).where("c > 1")
    members = stored(members.join(shared, ["band", "key"]), "buckets")
    # the text that meets most others stands in the middle of its group: it makes the best pivot
    degree = members.groupBy("th").agg(F.sum("c").alias("degree"))
    sets = stored(_sets(docs, degree.select("th")), "shingle-sets")
    members = members.join(degree, "th").select(
        "th", "n", "degree", "band", "key", F.col("th").alias("label"), F.lit(True).alias("apart"))
    found = docs.sparkSession.createDataFrame([], "a string, b string")
    for _ in range(PIVOTS):
        chosen = members.groupBy("band", "key").agg(F.max(F.struct("apart", "degree", "th", "n", "label")).alias("p"))
        chosen = chosen.select(
            "band", "key", F.col("p.th").alias("pivot"), F.col("p.n").alias("pn"), F.col("p.label").alias("pl"))
        met = stored(members.join(chosen, ["band", "key"]).where("th <> pivot").drop("apart"), "met")
        if met.isEmpty():
            return found
        # sets of sizes further apart than the similarity cannot reach it
        near = F.least("n", "pn") >= similarity * F.greatest("n", "pn") - 1e-9
        pairs = met.where(near & (F.col("label") != F.col("pl"))).select(
            F.least("th", "pivot").alias("a"), F.greatest("th", "pivot").alias("b")).distinct()
        found = found.unionByName(stored(_verified(pairs, sets, similarity), "links"))
        # the pivot has met all; the others, linked or not, go on while they are in different components
        labels = components(found)
        named = _labelled(met.drop("label"), labels, "th", "label")
        named = _labelled(named.drop("pl"), labels, "pivot", "pl")
        open_ = named.groupBy("band", "key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
        members = stored(named.join(open_, ["band", "key"], "left_semi").select(
            "th", "n", "degree", "band", "key", "label", (F.col("label") != F.col("pl")).alias("apart")), "left")
    rest = members.select("th", "label").distinct()
    return found.unionByName(_rest(rest, sets, found, similarity)).distinct()


def _labelled(rows: DataFrame, labels: DataFrame, node: str, name: str) -> DataFrame:
    """Rows with the component of a text, which is the text itself if it has no link."""
    other = labels.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
    return rows.join(other, F.col(node) == F.col("_n"), "left").withColumn(
        name, F.coalesce("_l", node)).drop("_n", "_l")


def _counts(rest: DataFrame) -> np.ndarray:
    """How often the shingles of a cell (their name modulo ``CELLS``) occur."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            np.add.at(total, batch.column(0).flatten().to_numpy().view(np.uint32) % CELLS, 1)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["cell", "c"])

    got = rest.select("shingles").mapInArrow(count, "cell long, c long").groupBy("cell").agg(F.sum("c").alias("c")).toArrow()
    out = np.zeros(CELLS, np.int64)
    out[got.column("cell").to_numpy()] = got.column("c").to_numpy()
    return out


def _rest(rest: DataFrame, sets: DataFrame, found: DataFrame, similarity: float) -> DataFrame:
    """Links between the components of ``rest`` (th, label): an exact join of sets by prefixes.

    Any order of the shingles is right for prefixes; the rarest cells first makes few meet. Two sets of
    the similarity share a shingle of their prefixes, and the first such leaves enough behind it.
    """
    rest = stored(sets.join(rest, "th").select("th", "label", "shingles"), "rest")
    shared = rest.sparkSession.sparkContext.broadcast(_counts(rest))

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            names = batch.column(2).flatten().to_numpy().view(np.uint32)
            sizes = pc.list_value_length(batch.column(2)).to_numpy()
            ends = np.cumsum(sizes)
            # about 200,000 shingles at once: most go no further than this task
            for a, b in _groups(sizes.tolist(), 200_000):
                first = ends[a] - sizes[a]
                own = names[first:ends[b - 1]]
                row = np.repeat(np.arange(a, b), sizes[a:b])
                own = own[np.lexsort((own, counts[own % CELLS], row))]
                place = np.arange(len(own)) - (ends - sizes - first)[row]
                keep = place <= sizes[row] - np.ceil(similarity * sizes[row] - 1e-9)
                row = row[keep]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)),
                     pa.array(sizes[row].astype(np.int64)), pa.array(own[keep].astype(np.int64)),
                     pa.array(place[keep].astype(np.int64))], names=["th", "label", "n", "s", "p"])

    heads = stored(rest.mapInArrow(prefix, "th string, label string, n long, s long, p long"), "prefixes")
    common = heads.groupBy("s").agg(
        F.count("*").alias("c"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("s", "c")
    heads = heads.join(common, "s").withColumn("blocks", F.ceil(F.col("c") / BLOCK).cast("int"))
    # the holders of a common shingle are dealt into blocks, and each of them meets every block
    one = heads.select("s", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("th").alias("a"),
                       F.col("label").alias("la"), F.col("n").alias("na"), F.col("p").alias("pa"))
    two = heads.select("s", F.pmod(F.xxhash64("th"), F.col("blocks")).cast("int").alias("block"), F.col("th").alias("b"),
                       F.col("label").alias("lb"), F.col("n").alias("nb"), F.col("p").alias("pb"))
    one, two = one.alias("one"), two.alias("two")
    most = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    meet = ((F.col("one.s") == F.col("two.s")) & (F.col("one.block") == F.col("two.block")) & (F.col("a") < F.col("b"))
            & (F.col("la") != F.col("lb")) & (F.least("na", "nb") >= similarity * F.greatest("na", "nb") - 1e-9)
            & (most * (1 + similarity) >= similarity * (F.col("na") + F.col("nb")) - 1e-9))
    pairs = stored(one.join(two, meet).groupBy("a", "b", "lb").agg(F.count("*").alias("c")), "candidates")
    # first the best of each text and component, as one link connects them; then what is still apart
    best = pairs.groupBy("a", "lb").agg(F.max(F.struct("c", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
    new = stored(_verified(stored(best, "best"), sets, similarity), "links")
    labels = components(found.unionByName(new))
    more = _labelled(_labelled(pairs.select("a", "b"), labels, "a", "la"), labels, "b", "lb").where("la <> lb").select("a", "b")
    return new.unionByName(stored(_verified(more, sets, similarity), "links"))


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node of each component, by spreading labels and, on long ways, following them."""
    both = stored(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_b")).select(
        "node", F.least("node", "_b").alias("label")), "labels")
    turn = 0
    while True:
        came = both.join(labels, F.col("b") == F.col("node")).select(F.col("a").alias("node"), "label", F.lit(None).alias("old"))
        own = labels.select("node", "label", F.col("label").alias("old"))
        low = stored(came.unionByName(own).groupBy("node").agg(
            F.min("label").alias("label"), F.max("old").alias("old")), "labels")
        if low.where("label <> old").isEmpty():
            return labels
        labels, turn = low.select("node", "label"), turn + 1
        if turn > 2:
            up = labels.select(F.col("node").alias("_n"), F.col("label").alias("_up"))
            labels = stored(labels.join(up, F.col("label") == F.col("_n")).select(
                "node", F.least("label", "_up").alias("label")), "labels")


def text_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """th, class (the least digest of its component), rep (least id with this text) and n_rows of each text."""
    nodes = stored(_nodes(docs), "texts")
    labels = components(links(docs, nodes, similarity))
    joined = nodes.join(labels, F.col("th") == F.col("node"), "left")
    return stored(joined.select("th", F.coalesce("label", "th").alias("class"), "rep", "n_rows"), "classes")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (least id of the class), class_rows and n_texts (different texts) of every row.

    Equal texts are always one class, the empty text included; a null text is a class of its own with
    its own id. Rows with a null id take part, and lend their class no id.
    """
    classes = text_classes(docs, similarity)
    whole = classes.groupBy("class").agg(
        F.min("rep").alias("class_id"), F.sum("n_rows").alias("class_rows"), F.count("*").alias("n_texts"))
    by_text = classes.select("th", F.col("class").alias("_class")).join(whole, F.col("_class") == F.col("class"))
    by_text = by_text.select(F.col("th").alias("_th"), "class_id", "class_rows", "n_texts")
    rows = docs.select("doc_id", digest().alias("th"))
    joined = rows.join(by_text, F.col("th") == F.col("_th"), "left")
    return joined.select(
        "doc_id", F.when(F.col("th").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_rows", F.lit(1)).alias("class_rows"), F.coalesce("n_texts", F.lit(1)).alias("n_texts"))


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents with one row left of each class: that of the least id. Rows of null text stay."""
    classes = text_classes(docs, similarity)
    best = classes.groupBy("class").agg(
        F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "th")).alias("m")).select("m.th").withColumnRenamed("th", "_best")
    marked = classes.join(best, F.col("th") == F.col("_best"), "left")
    # texts that lose rows: all of them, or all but those of the least id
    losing = marked.where(F.col("_best").isNull() | (F.col("n_rows") > 1)).select(
        F.col("th").alias("_th"), F.col("rep").alias("_rep"), F.col("_best").isNotNull().alias("_stays"))
    rows = docs.withColumn("_d", digest())
    joined = rows.join(broadcast_if_bounded(losing), F.col("_d") == F.col("_th"), "left")
    kept = joined.where(
        F.col("_th").isNull() | (F.col("_stays") & F.col("doc_id").eqNullSafe(F.col("_rep"))))
    kept = stored(kept.select(*docs.columns, "_d", F.col("_th").isNotNull().alias("_again")), "kept")
    once = kept.where(~F.col("_again")).select(*docs.columns)
    return once.unionByName(kept.where("_again").dropDuplicates(["_d"]).select(*docs.columns))
