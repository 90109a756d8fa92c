"""MinHash near-dedup with b-bit signatures.

Documents are linked when the Jaccard similarity of their sets of distinct
5-word shingles is at least 0.75 (``100 * intersection >= 75 * union``);
groups are the connected components of these links.

1. Exact copies collapse by text key; the texts move through one shuffle.
2. The first 128 minima per text make 32 bands of 4. At the threshold a pair shares no
   band with probability (1 - 0.75^4)^32 = 5e-6. Texts without a shared band
   need no further look.
3. Texts with a shared band get 1,024 minima, of which only the low 4 bits are
   kept, packed into sixty-four 64-bit words.
   Each bucket has a centre, and every text is paired with one of its buckets'
   centres, the one it shares most buckets with (one pair a text, not all
   pairs). The share of equal 4-bit fields is counted with bit operations and
   corrected for chance matches (1 in 16), and pairs far below the threshold
   (4.5 standard errors) go. The rest are confirmed on full sets. This is
   repeated with other centres for whole components, one pair a component,
   while it links any.
4. Components come from stars within blocks of links and, over several blocks,
   iterated minimum labels. Buckets that still hold
   several components are searched again for pairs *between* components, by
   the same signatures: first each outsider's most similar text outside its
   component, a few times over, then, in rounds of growing shares of the pairs,
   whichever pairs are still in different components. Confirmed links join the others after
   each round. Groups close up after a round or two, so few pairs are left to
   confirm, yet none is left out. A bucket is searched in cells of about a
   thousand outsiders by a thousand members, whatever its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import textkit
from tillroll.llm.repeats import join_hot, key_slabs
from tillroll.session import materialize

SHINGLE_WORDS = 5
LINK_PERCENT = 75
BANDS = 32
ROWS = 4
BITS = 4
BANDED = BANDS * ROWS
MINIMA = 1024
SIGNATURE_WORDS = MINIMA * BITS // 64
CELL = 1024
# Links that one task connects at once (about 32 bytes each).
BLOCK = 1 << 17
STAR_ROUNDS = 2
# Rounds in which an outsider is paired with its most similar text of another
# component; after them: all pairs by hash, in shares of 64.
BEST_ROUNDS = 2
SHARES = ((0, 8), (8, 64))
# 4.5 standard errors of the estimate at the threshold (missed with 3e-6),
# where 4-bit fields agree with probability 1/16 + 15/16 * 0.75.
_AGREE = 1 / 16 + 15 / 16 * 0.75
SLACK = 4.5 * (_AGREE * (1 - _AGREE) / MINIMA) ** 0.5 / (15 / 16)

_rng = np.random.Generator(np.random.PCG64(20))
_FLIP = _rng.integers(0, 1 << 63, MINIMA, dtype=np.uint64)
_SPREAD = _rng.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_JOIN = _rng.integers(0, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, first)``: 64-bit shingle hashes of all rows, repeats included."""
    starts, ends, first = textkit.word_spans(textkit.LOWER[data], offsets, textkit.SPACES)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    words = textkit.span_hashes(textkit.LOWER[data], starts, ends)
    n_words = np.diff(first)
    # a row of fewer words has its whole sequence as one shingle
    width = np.minimum(n_words, SHINGLE_WORDS)
    counts = np.where(n_words > 0, n_words - width + 1, 0)
    out_first = np.concatenate([[0], np.cumsum(counts)])
    row = np.repeat(np.arange(len(n_words)), counts)
    begin = first[row] + np.arange(out_first[-1]) - out_first[row]
    return textkit.span_hashes(words, begin, begin + width[row]), out_first


def minima(hashes: np.ndarray, first: np.ndarray, count: int = MINIMA) -> np.ndarray:
    """``(rows, count)`` of the non-empty rows."""
    heads = first[:-1][np.diff(first) > 0]
    out = np.empty((len(heads), count), np.uint64)
    for i in range(count):
        out[:, i] = np.minimum.reduceat((hashes ^ _FLIP[i]) * _SPREAD[i], heads)
    return out


def band_keys(mins: np.ndarray) -> np.ndarray:
    joined = (mins[:, :BANDED].reshape(-1, BANDS, ROWS) * _JOIN).sum(axis=2, dtype=np.uint64)
    return textkit.mix(joined + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def signatures(mins: np.ndarray) -> np.ndarray:
    """Low bits of the mixed minima, packed 16 to a 64-bit word. Unmixed, the low
    bits of two shingles would agree for all functions or for none."""
    low = (textkit.mix(mins.copy()) & np.uint64((1 << BITS) - 1)).reshape(-1, SIGNATURE_WORDS, 64 // BITS)
    return np.bitwise_or.reduce(low << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)), axis=2).view(np.int64)


def _lists(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel()))


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = textkit.column_bytes(batch.column("text"))
        nodes = batch.column("node")
        for lo, hi in textkit.row_slices(offsets):
            base = offsets[lo]
            hashes, first = shingle_hashes(data[base : offsets[hi]], offsets[lo : hi + 1] - base)
            if not len(hashes):
                continue
            keys = band_keys(minima(hashes, first, BANDED))
            some = pa.array(np.repeat(np.flatnonzero(np.diff(first) > 0), BANDS))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), nodes.slice(lo, hi - lo).take(some)], ["band", "node"])


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text the set size, and for candidates bands, signature and set."""
    for batch in batches:
        data, offsets = textkit.column_bytes(batch.column("text"))
        candidate = batch.column("candidate").to_numpy(zero_copy_only=False).astype(bool)
        for lo, hi in textkit.row_slices(offsets):
            base = offsets[lo]
            hashes, first = shingle_hashes(data[base : offsets[hi]], offsets[lo : hi + 1] - base)
            sizes, sets = [], []
            for r in range(hi - lo):
                own = np.unique(hashes[first[r] : first[r + 1]])
                sizes.append(len(own))
                sets.append(own.tobytes() if candidate[lo + r] else None)
            picked = np.flatnonzero(candidate[lo:hi] & (np.diff(first) > 0))
            bands = pa.nulls(hi - lo, pa.list_(pa.int64()))
            marks = bands
            if len(picked):
                # the candidates' rows alone, one after the other
                sizes_picked = np.diff(first)[picked]
                own_first = np.concatenate([[0], np.cumsum(sizes_picked)])
                own = np.repeat(first[picked] - own_first[:-1], sizes_picked) + np.arange(own_first[-1])
                chosen = minima(hashes[own], own_first)
                index = np.full(hi - lo, -1)
                index[picked] = np.arange(len(picked))
                take = pa.array(index, mask=index < 0)
                bands, marks = _lists(band_keys(chosen)).take(take), _lists(signatures(chosen)).take(take)
            own = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [own.column("node"), own.column("root"), pa.array(sizes, pa.int64()), bands, marks, pa.array(sets, pa.binary())],
                ["node", "root", "n", "bands", "marks", "shingles"],
            )


def estimate(a: str, b: str) -> Column:
    """Collision-corrected similarity of two packed signatures, by bit counts."""
    low = int("1" * (64 // BITS), 16)

    def fields(x: Column) -> Column:
        """How many of a word's fields are not zero."""
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        return F.bit_count(x.bitwiseAND(F.lit(low)))

    words = F.zip_with(a, b, lambda p, q: fields(p.bitwiseXOR(q)))
    differ = F.aggregate(words, F.lit(0), lambda total, n: total + n)
    chance = 1.0 / (1 << BITS)
    equal = F.lit(1.0) - differ / F.lit(float(MINIMA))
    return (equal - F.lit(chance)) / F.lit(1 - chance)


def _estimates(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    x = (one ^ many).view(np.uint64)
    x = x | (x >> np.uint64(1))
    x = x | (x >> np.uint64(2))
    low = np.uint64(int("1" * (64 // BITS), 16))
    equal = 1 - np.bitwise_count(x & low).sum(axis=1) / MINIMA
    chance = 1.0 / (1 << BITS)
    return (equal - chance) / (1 - chance)


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("set_a"), batch.column("set_b")):
            a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            small, large = (a, b) if len(a) <= len(b) else (b, a)
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            common = int((large[at] == small).sum())
            keep.append(100 * common >= percent * (len(a) + len(b) - common))
        mask = pa.array(keep, pa.bool_())
        out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(mask)
        if out.num_rows:
            yield out


def _between(batches: Iterator[pa.RecordBatch], floor: float, share: tuple[int, int] | None) -> Iterator[pa.RecordBatch]:
    """Pairs of likely similar texts of different components in one cell.

    A pair is given out in the first bucket its texts share. Without ``share``
    this is, for every outsider, the best partner of the cell; with it the pairs whose hash falls into that share. Pairs that are
    left for later rounds are reported by one text paired with itself.
    """
    later = share is None or share[1] < 64
    for slab in key_slabs(batches, "cell", 4096):
        cells = slab.column("cell").to_numpy()
        pos = slab.column("pos").to_numpy()
        nodes = slab.column("node").to_pylist()
        names = {v: i for i, v in enumerate(set(slab.column("label").to_pylist()))}
        labels = slab.column("label").to_pylist()
        group = np.array([names[v] for v in labels])
        is_left, is_member, outsider = (slab.column(c).to_numpy().astype(bool) for c in ("is_left", "is_member", "outsider"))
        marks = np.array(slab.column("marks").combine_chunks().flatten().to_numpy()).reshape(-1, SIGNATURE_WORDS)
        bands = np.array(slab.column("bands").combine_chunks().flatten().to_numpy()).reshape(-1, BANDS)
        heads = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])).tolist() + [len(cells)]
        left, right, scores, waiting = [], [], [], None
        for x, y in zip(heads, heads[1:]):
            members = x + np.flatnonzero(is_member[x:y])
            for i in (x + np.flatnonzero(is_left[x:y])).tolist():
                other = members[group[members] != group[i]]
                if not len(other):
                    continue
                score = _estimates(marks[i], marks[other])
                likely = score >= floor
                other, score = other[likely], score[likely]
                if not len(other):
                    continue
                common = bands[other] == bands[i]
                keep = common[:, pos[i]] & (common.argmax(axis=1) == pos[i])
                # two outsiders meet in both directions
                keep &= np.fromiter((not outsider[j] or nodes[i] < nodes[j] for j in other.tolist()), bool, len(other))
                other, score = other[keep], score[keep]
                if not len(other):
                    continue
                if share is None:
                    if len(other) > 1:
                        waiting = i
                    best = score.argmax()
                    other, score = other[best : best + 1], score[best : best + 1]
                else:
                    place = np.array([_place(nodes[i], nodes[j]) for j in other.tolist()])
                    if (place >= share[1]).any():
                        waiting = i
                    now = (place >= share[0]) & (place < share[1])
                    other, score = other[now], score[now]
                left += [i] * len(other)
                right += other.tolist()
                scores += score.tolist()
        if later and waiting is not None:
            left.append(waiting)
            right.append(waiting)
            scores.append(0.0)
        if left:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([nodes[i] for i in left], pa.binary()),
                    pa.array([nodes[j] for j in right], pa.binary()),
                    pa.array([labels[j] for j in right], pa.binary()),
                    pa.array(scores, pa.float64()),
                ],
                ["a", "b", "label", "score"],
            )


def _place(a: bytes, b: bytes) -> int:
    """0 to 63 by the hash of a pair; the texts' keys are hashes already."""
    return (a[0] ^ b[0]) & 63


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task as stars ``(node, label)`` around the least node of
    each group they connect; after ``BLOCK`` links the next stars begin."""
    above: dict[bytes, bytes] = {}

    def top(x: bytes) -> bytes:
        path = []
        while (up := above.setdefault(x, x)) != x:
            path.append(x)
            x = up
        for y in path:
            above[y] = x
        return x

    def stars() -> pa.RecordBatch:
        nodes = list(above)
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(list(map(top, nodes)), pa.binary())], ["node", "label"])

    links = 0
    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            x, y = top(a), top(b)
            if x != y:
                above[max(x, y)] = min(x, y)
            links += 1
            if links == BLOCK:
                yield stars()
                above.clear()
                links = 0
    if above:
        yield stars()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, label)`` of every node of ``edges(a, b)``: the least node of its
    component. Blocks of at most ``BLOCK`` links first become stars, each in
    one task; a single block is done with that. Over the stars of several
    blocks each round takes the least label around a node and then that
    label's own label, until nothing changes; tables between rounds are
    written to the shared scratch folder. ``edges`` are read twice."""
    blocks = -(-edges.count() // BLOCK)
    stars = materialize(edges.coalesce(max(1, blocks)).mapInArrow(_stars, "node binary, label binary"), f"{name}-stars")
    if blocks <= 1:
        return stars
    both = stars.select(F.col("node").alias("a"), F.col("label").alias("b")).filter("a <> b")
    both = materialize(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    # a node linked with itself alone has a star, but no neighbour
    labels = materialize(stars.groupBy("node").agg(F.min("label").alias("label")), f"{name}-0")
    for turn in range(1, 100):
        around = (
            both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("least"))
        )
        lower = labels.join(around.withColumnRenamed("a", "node"), "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", "least").alias("label")
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        labels_next = materialize(
            lower.join(jump, "label", "left").select("node", "old", F.coalesce("beyond", "label").alias("label")),
            f"{name}-{turn}",
        )
        changed = labels_next.filter("old <> label").limit(1).count()
        labels = labels_next.select("node", "label")
        if not changed:
            return labels
    raise RuntimeError("components did not settle")


_FEATURES = "node binary, root bigint, n bigint, bands array<bigint>, marks array<bigint>, shingles binary"


def _node(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit(""))))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rest = F.struct(F.col(id_col), *[F.col(c) for c in docs.columns if c not in (id_col, text_col)])
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return (
        docs.select(_node(F.col(text_col)).alias("node"), text.alias("text"), F.col(id_col).cast("bigint").alias("_id"), rest.alias("doc"))
        .groupBy("node")
        .agg(F.min("_id").alias("root"), F.first("text").alias("text"), F.min_by("doc", F.coalesce("_id", F.lit(2**63 - 1))).alias("doc"))
    )


def _confirmed(pairs: DataFrame, found: DataFrame, percent: int, floor: float | None = None) -> DataFrame:
    """Pairs ``(a, b)`` whose full sets reach the threshold; with ``floor`` only
    those whose signatures reach that are compared."""
    for side in ("a", "b"):
        taken = [F.col("node").alias(side), F.col("shingles").alias(f"set_{side}")]
        if floor is not None:
            taken.append(F.col("marks").alias(f"marks_{side}"))
        pairs = pairs.join(found.select(*taken), side)
    if floor is not None:
        pairs = pairs.filter(estimate("marks_a", "marks_b") >= F.lit(floor))
    return pairs.select("a", "b", "set_a", "set_b").mapInArrow(lambda it: _confirm(it, percent), "a binary, b binary")


def _star_pairs(found: DataFrame, labels: DataFrame | None, turn: int) -> DataFrame:
    """One pair ``(a, b)`` per component that shares a bucket with another one.

    A component is represented in a bucket by one of its texts, and the bucket
    by one of these, both by a hash that differs from turn to turn. Of the
    pairs with its buckets' centres a component keeps the one that occurs in
    most buckets.
    """
    placed = found.select("node", F.explode("bands").alias("band"))
    if labels is None:
        placed = placed.withColumn("label", F.col("node"))
    else:
        placed = found.select("node", "bands").join(labels, "node", "left").select(
            "node", F.explode("bands").alias("band"), F.coalesce("label", "node").alias("label")
        )
    least = F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "label")).alias("x")
    stands = placed.groupBy("band", "label").agg(least).select("band", "x")
    centres = (
        stands.groupBy("band")
        .agg(F.min("x").alias("centre"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("band", "centre")
    )
    pairs = (
        join_hot(stands, centres, ["band"])
        .filter("x.label <> centre.label")
        .groupBy(F.col("x.label").alias("label"), F.col("centre.node").alias("a"), F.col("x.node").alias("b"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return pairs.groupBy("label").agg(F.max(F.struct("n", "a", "b")).alias("most")).select("most.a", "most.b")


def _seats(found: DataFrame, labels: DataFrame) -> DataFrame:
    """The places ``(band, pos, node)`` of all buckets that hold several
    components, with the bucket's numbers of cells. Texts outside the bucket's
    largest component are its outsiders."""
    first = labels.select("node", F.col("label").alias("first"))
    placed = (
        found.select("node", F.posexplode("bands").alias("pos", "band"))
        .join(first, "node", "left")
        .withColumn("first", F.coalesce("first", "node"))
    )
    buckets = (
        placed.groupBy("band", "first")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("band")
        .agg(F.max(F.struct("n", "first")).alias("largest"), F.sum("n").alias("n"))
        .filter("n > largest.n")
        .select(
            "band",
            F.col("largest.first").alias("largest"),
            F.ceil(F.col("n") / CELL).alias("member_cells"),
            F.ceil((F.col("n") - F.col("largest.n")) / CELL).alias("outsider_cells"),
        )
    )
    return join_hot(placed, buckets, ["band"]).select(
        "band", "pos", "node", "member_cells", "outsider_cells", (F.col("first") != F.col("largest")).alias("outsider")
    )


def _cells(seats: DataFrame, labels: DataFrame) -> DataFrame:
    """The seats under the cells they are compared in.

    The cells of a bucket are a grid of parts of its outsiders and parts of its
    members. An outsider goes to all cells of its row and a member to all of
    its column, so each pair meets in one cell and no cell grows with the
    bucket. Buckets of one component by now are left out.
    """
    labelled = seats.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = (
        labelled.groupBy("band").agg(F.min("label").alias("_least"), F.max("label").alias("_most")).filter("_least <> _most").select("band")
    )
    own = F.xxhash64("node", "band")
    cell = lambda i, k: F.struct(i.alias("i"), k.alias("k"))
    return (
        join_hot(labelled, mixed, ["band"])
        .withColumns({"row": F.pmod(own, "outsider_cells"), "column": F.pmod(F.shiftright(own, 20), "member_cells")})
        .withColumn("as_member", F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("outsider_cells") - 1), lambda i: cell(i, F.col("column"))))
        .withColumn("as_left", F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("member_cells") - 1), lambda k: cell(F.col("row"), k)))
        .withColumn("at", F.explode(F.when(F.col("outsider"), F.array_union("as_member", "as_left")).otherwise(F.col("as_member"))))
        .select(
            # equal hashes of two cells do no harm: pairs are tested for a common bucket
            F.xxhash64("band", "at.i", "at.k").alias("cell"),
            "pos",
            "node",
            "label",
            "outsider",
            (F.col("at.k") == F.col("column")).alias("is_member"),
            (F.col("outsider") & (F.col("at.i") == F.col("row"))).alias("is_left"),
        )
    )


def _across(seats: DataFrame, found: DataFrame, labels: DataFrame, floor: float, share: tuple[int, int] | None) -> DataFrame:
    """One round of pairs ``(a, b)`` between the present components; ``more``
    or a text paired with itself tells of pairs left for later rounds."""
    pairs = (
        _cells(seats, labels).join(found.select("node", "marks", "bands"), "node")
        .repartition("cell")
        .sortWithinPartitions("cell")
        .mapInArrow(lambda it: _between(it, floor, share), "a binary, b binary, label binary, score double")
    )
    if share is None:
        # n > 1: cells had partners that are not the best of all
        best = pairs.groupBy("a").agg(F.max(F.struct("score", "b")).alias("best"), F.count(F.lit(1)).alias("n"))
        return best.select("a", F.col("best.b").alias("b"), (F.col("n") > 1).alias("more"))
    return pairs.select("a", "b", F.lit(False).alias("more"))


def _join_label(nodes: DataFrame, least: DataFrame) -> DataFrame:
    """``nodes.join(least, "label")``, joined on a longer key than ``least`` was
    grouped by: both sides are shuffled, and a large component can be split."""
    longer = lambda label: F.concat(label, F.lit(b"\0"))
    keys = least.select(longer(F.col("label")).alias("_label"), *[c for c in least.columns if c != "label"])
    return nodes.join(keys, longer(nodes["label"]) == keys["_label"]).drop("_label")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = LINK_PERCENT) -> DataFrame:
    """One row per distinct text: ``node`` (its key), ``n`` (set size), ``root``
    (least id of its copies), ``component_id`` (least id of its component)."""
    texts = _texts(docs.select(id_col, text_col), id_col, text_col)
    bands = texts.mapInArrow(_band_rows, "band bigint, node binary")
    shared = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.bitwise_not("band").alias("_band"))
    candidates = (
        bands.join(shared, F.bitwise_not(bands["band"]) == shared["_band"])
        .groupBy("node")
        .agg(F.lit(True).alias("candidate"))
    )
    features = materialize(
        texts.join(candidates, "node", "left")
        .withColumn("candidate", F.coalesce("candidate", F.lit(False)))
        .mapInArrow(_feature_rows, _FEATURES),
        "near-features",
    )
    found = features.filter("bands is not null")
    floor = percent / 100 - SLACK
    links, labels = None, None
    for turn in range(STAR_ROUNDS):
        new = materialize(_confirmed(_star_pairs(found, labels, turn), found, percent, floor), "near-links")
        some = new.limit(1).count()
        if some or links is None:
            links = new if links is None else links.unionByName(new)
            labels = components(links, "near-first")
        if not some:
            break

    seats = materialize(_seats(found, labels), "near-seats")
    rounds = [None] * BEST_ROUNDS + list(SHARES)
    while rounds:
        share = rounds.pop(0)
        across = materialize(_across(seats, found, labels, floor, share), "near-across")
        more = materialize(_confirmed(across.filter("a <> b").select("a", "b"), found, percent), "near-more-links")
        if more.limit(1).count():
            links = links.unionByName(more)
            labels = components(links, "near-next")
        elif share is None:
            rounds = list(SHARES)
        if not across.filter("a = b OR more").limit(1).count():
            break

    nodes = features.select("node", "root", "n").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = nodes.groupBy("label").agg(F.min("root").alias("component_id"))
    return _join_label(nodes, least).select("node", "n", "root", "component_id")


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = LINK_PERCENT) -> DataFrame:
    """Every row's group: ``n_shingles``, ``component_id`` and ``kept``.

    The least id of a component names it and is kept. A null text, or one
    without words, has an empty set and stays alone. A row repeated in full
    gets the same result twice. Rows without an id take part; they are kept
    only in components without any id. Other columns are not used.
    """
    rows = docs.select(F.col(id_col).alias(id_col), _node(F.col(text_col)).alias("node"))
    out = rows.join(classes(docs, id_col, text_col, percent), "node")
    component = F.when(F.col("n") == 0, F.col(id_col)).otherwise(F.col("component_id"))
    return out.select(
        id_col,
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col(id_col).eqNullSafe(component).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = LINK_PERCENT) -> DataFrame:
    """``docs`` with one row of each group (that of the least id; one of its
    copies); all rows without words stay. Columns are those of ``docs``."""
    groups = classes(docs, id_col, text_col, percent).filter("n > 0")
    first = groups.groupBy("component_id").agg(F.min(F.struct(F.coalesce("root", F.lit(2**63 - 1)), "node")).alias("_least"))
    chosen = first.select(F.col("_least.node").alias("node"))
    names = [c for c in docs.columns if c != text_col]
    one = _texts(docs, id_col, text_col).join(chosen, "node", "left_semi").select(*[F.col("doc").getField(c).alias(c) for c in names], "text")
    wordless = docs.filter(~F.coalesce(F.col(text_col), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    return one.withColumnRenamed("text", text_col).select(docs.columns).unionByName(wordless)
