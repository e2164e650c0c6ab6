"""Classes of near duplicates: a Jaccard join on word shingles by PartEnum signatures.

Sets of one size band share a partition of the shingle domain into groups of `PARTS` parts. A signature is what a set
holds in all parts of a group but `OMITTED`; every choice of these parts is enumerated. Two sets of similarity 0.8
differ in at most a quarter of the smaller set's size, `d`, so of any `d // (OMITTED + 1) + 1` groups one has at most
`OMITTED` parts in which they differ, and the signature without these parts is the same for both. A signature of
nothing would join everything, so it is left out, and a set counts only those groups in which no signature is empty
(rich ones): it emits the groups up to its last needed rich one. The first group that is rich for either set and has few
differences lies before that end for both. Sets with too few rich groups emit all of them and, to meet each other,
their first `d + 1` shingles in hash order.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chirrup.llm.common import stored_alone, tasks, text_key, text_or_empty
from chirrup.llm.pretokens import chunks, text_buffers
from chirrup.llm.words import LOWER, grams, hashed_words, mixed, within, word_spans

SHINGLE = 5
# Linked at 100 * intersection >= 80 * union: then the sets differ in at most size // 4 shingles.
LEAST_PERCENT = 80
PARTS, OMITTED = 2, 1
BAND = 2.0
SPARE = 1.25

# Rounds in which each set is compared with one other set of its bucket; the rest is compared exhaustively in blocks.
STAR_ROUNDS = 1
BLOCK = 1024

# A sketch has a power of two of cells, so many at least, and on average at most `LOAD` shingles in one. Unrelated sets of
# over 26 shingles a cell may seem linked. Blocks take a coarser one, as a set is in many of them.
CELLS = 256
LOAD, BLOCK_LOAD, MOST_BLOCK_CELLS = 4, 16, 4096

_SETS = "doc_id long, n_shingles long, node long, check long, text_key binary"
_SIGNATURES = "signature long, node long"


class Sets:
    """The distinct shingles of texts, sorted by hash within each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = LOWER[data]
        begins, ends, first = word_spans(data, offsets)
        words, counts = hashed_words(data, begins, ends), np.diff(first)
        places = within(first, SHINGLE)
        shingles = grams(words, SHINGLE)[places] if len(places) else np.zeros(0, np.uint64)
        text = np.searchsorted(first, places, "right") - 1
        short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
        whole = [grams(words[first[k] : first[k + 1]], int(counts[k]))[0] for k in short.tolist()]
        shingles = np.concatenate([shingles, np.array(whole, np.uint64) ^ np.uint64(1)])
        text = np.concatenate([text, short])
        if len(short):
            order = np.argsort(text, kind="stable")
            shingles, text = shingles[order], text[order]
        bounds = np.searchsorted(text, np.arange(len(offsets))).tolist()
        # Many short sorts take half the time of one over two keys.
        for a, b in zip(bounds[:-1], bounds[1:]):
            shingles[a:b].sort()
        fresh = np.ones(len(text), bool)
        fresh[1:] = (shingles[1:] != shingles[:-1]) | (text[1:] != text[:-1])
        self.shingles, self.text = shingles[fresh], text[fresh]
        self.first = np.searchsorted(self.text, np.arange(len(offsets)))
        self.sizes = np.diff(self.first)

    def sums(self, seed: int) -> np.ndarray:
        """A hash of each set."""
        spread = mixed(self.shingles + np.uint64(seed))
        total = np.append(np.uint64(0), np.cumsum(spread, dtype=np.uint64))
        return mixed(total[self.first[1:]] - total[self.first[:-1]] + self.sizes.astype(np.uint64))

    def part(self, k: int) -> np.ndarray:
        return self.shingles[self.first[k] : self.first[k + 1]]


def sets_of(column: pa.Array) -> Iterator[tuple[int, int, Sets]]:
    offsets, data = text_buffers(column)
    for a, b in chunks(offsets):
        yield a, b, Sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def signatures(sets: Sets, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The signatures of the chosen sets, and which set each is of."""
    sizes = sets.sizes.astype(np.int64)
    most = sizes // 4
    band = np.ceil(np.log(np.maximum(sizes, 1)) / np.log(BAND)).astype(np.int64)
    found, owners, failed = [], [], np.zeros(len(sizes), bool)
    for shift in (0, 1):
        # Above: sets whose partners may be in the next band.
        here = chosen & (sizes > 0) & ((shift == 0) | (1.25 * sizes > BAND**band))
        level = band + shift
        need = most // (OMITTED + 1) + 1
        groups = np.ceil(SPARE * BAND**level / 4 / (OMITTED + 1)).astype(np.int64) + 1
        base = np.append(0, np.cumsum(np.where(here, groups, 0)))
        own = here[sets.text]
        shingles, text = sets.shingles[own], sets.text[own]
        spread = mixed(shingles + level[text].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        group = (spread >> np.uint64(16)) % groups[text].astype(np.uint64)
        part = (spread & np.uint64(0xFFFF)) % np.uint64(PARTS)
        cell = (base[text] + group.astype(np.int64)) * PARTS + part.astype(np.int64)
        n_cells = int(base[-1]) * PARTS
        held = np.bincount(cell, minlength=n_cells).reshape(-1, PARTS)
        sums = np.zeros(n_cells, np.uint64)
        np.add.at(sums, cell, mixed(spread))
        sums = sums.reshape(-1, PARTS)
        owner = np.repeat(np.arange(len(sizes)), np.diff(base))
        rich = (held > 0).sum(1) > OMITTED
        before = np.append(0, np.cumsum(rich))
        emitted = before[:-1] - before[base[:-1]][owner] < need[owner]
        if shift == 0:
            failed = here & (before[base[1:]] - before[base[:-1]] < need)
        number = (np.arange(len(owner)) - base[:-1][owner]).astype(np.uint64)
        total, count = sums.sum(1, dtype=np.uint64), held.sum(1)
        for omitted in range(PARTS):
            use = emitted & (count > held[:, omitted])
            label = mixed((level[owner[use]].astype(np.uint64) << np.uint64(40)) + number[use] * np.uint64(PARTS) + np.uint64(omitted + 1))
            found.append(mixed((total - sums[:, omitted])[use] ^ label))
            owners.append(owner[use])
        if shift == 1:
            failed |= here & (before[base[1:]] - before[base[:-1]] < need)
    place = np.arange(len(sets.text)) - sets.first[sets.text]
    plain = failed[sets.text] & (place <= most[sets.text])
    found.append(mixed(sets.shingles[plain] ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    owners.append(sets.text[plain])
    return np.concatenate(found), np.concatenate(owners)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Both sorted and distinct."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= LEAST_PERCENT * (len(a) + len(b) - both)


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Sets, np.ndarray, pa.RecordBatch]]:
    for batch in batches:
        for a, b, sets in sets_of(batch.column("text")):
            yield sets, sets.sums(1).view(np.int64), batch.slice(a, b - a)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for sets, node, batch in _seen(batches):
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sets.sizes.astype(np.int64)), pa.array(node), pa.array(sets.sums(2).view(np.int64)), batch.column("text_key")],
            ["doc_id", "n_shingles", "node", "check", "text_key"],
        )


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The signatures of each set once in each piece of a batch."""
    for sets, node, _ in _seen(batches):
        chosen = np.zeros(len(node), bool)
        chosen[np.unique(node, return_index=True)[1]] = True
        found, owner = signatures(sets, chosen)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(node[owner])], ["signature", "node"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sides = []
        for name in ("text_a", "text_b"):
            coded = batch.column(name).dictionary_encode()
            sets = {}
            for first, last, found in sets_of(coded.dictionary):
                sets |= {first + k: found.part(k) for k in range(last - first)}
            sides.append([sets[code] for code in coded.indices.to_pylist()])
        keep = [linked(a, b) for a, b in zip(*sides)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(keep, pa.bool_())], ["a", "b", "linked"])


def _folded(cells: np.ndarray, n: int) -> np.ndarray:
    """The sketch with `n` cells: each is the sum of cells that lie side by side."""
    return cells.reshape(n, -1).sum(1, dtype=np.int32)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many shingles fall into each cell, at most 255; `coarse` has fewer cells."""
    for batch in batches:
        for a, b, sets in sets_of(batch.column("text")):
            bits, low = (np.log2(np.maximum(sets.sizes / load, CELLS)) for load in (LOAD, BLOCK_LOAD))
            bits = np.ceil(bits).astype(np.int64)
            coarse = np.minimum(1 << np.ceil(low).astype(np.int64), MOST_BLOCK_CELLS).tolist()
            base = np.append(0, np.cumsum(1 << bits))
            cell = base[sets.text] + (sets.shingles >> (64 - bits)[sets.text].astype(np.uint64)).astype(np.int64)
            counts = np.minimum(np.bincount(cell, minlength=int(base[-1])), 255).astype(np.uint8)
            fine = [counts[x:y] for x, y in zip(base[:-1].tolist(), base[1:].tolist())]
            folded = [np.minimum(_folded(cells, n), 255).astype(np.uint8) for cells, n in zip(fine, coarse)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node").slice(a, b - a), pa.array(sets.sizes.astype(np.int64)),
                    *(pa.array([x.tobytes() for x in column], pa.binary()) for column in (fine, folded)),
                ],
                ["node", "n", "cells", "coarse"],
            )


def _close(apart: np.ndarray | int, sizes: np.ndarray | int) -> np.ndarray | bool:
    """Linked sets differ in at most a fifth of their union, that is a ninth of the sum of their sizes."""
    return 9 * apart <= sizes


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs that may be linked, by sizes and cells."""
    for batch in batches:
        n, m = (batch.column(name).to_numpy() for name in ("n_a", "n_b"))
        keep = 100 * np.minimum(n, m) >= LEAST_PERCENT * np.maximum(n, m)
        for k in np.flatnonzero(keep).tolist():
            one, two = (np.frombuffer(batch.column(name)[k].as_buffer(), np.uint8) for name in ("cells_a", "cells_b"))
            least = min(len(one), len(two))
            keep[k] = _close(np.abs(_folded(one, least) - _folded(two, least)).sum(), n[k] + m[k])
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a block that may be linked, by sizes and cells; the blocks come sorted."""

    def pairs(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        if len(rows) < 2:
            return
        node, component, n = (np.array([row[k] for row in rows]) for k in (4, 5, 6))
        side = np.array([row[3] for row in rows])
        sketches = [np.frombuffer(row[7], np.uint8) for row in rows]
        counts = np.array([len(x) for x in sketches])
        # Sets of near sizes have the same number of cells, or one has twice as many, which are folded.
        cells = {c: np.zeros((len(rows), c), np.int16) for c in set(counts.tolist())}
        for c, at in cells.items():
            for k in np.flatnonzero((counts == c) | (counts == 2 * c)).tolist():
                at[k] = _folded(sketches[k], c) if counts[k] > c else sketches[k]
        across = rows[0][1] != rows[0][2]
        for k in range(len(rows)):
            if across and side[k]:
                continue
            others = np.flatnonzero(side == 1) if across else np.arange(k + 1, len(rows))
            least, most = np.minimum(n[others], n[k]), np.maximum(n[others], n[k])
            others = others[(component[others] != component[k]) & (100 * least >= LEAST_PERCENT * most)]
            common = np.minimum(counts[others], counts[k])
            for c, at in cells.items():
                near = others[common == c]
                apart = np.abs(at[near] - at[k]).sum(1)
                for j in near[_close(apart, n[near] + n[k])].tolist():
                    yield (int(node[k]), int(node[j])) if node[k] < node[j] else (int(node[j]), int(node[k]))

    held: list[tuple] = []
    out: set[tuple[int, int]] = set()
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if held and row[:3] != held[0][:3]:
                out.update(pairs(held))
                held = []
            held.append(row)
        if len(out) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["a", "b"])
            out = set()
    out.update(pairs(held))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["a", "b"])


def contracted(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Merge the components that edges join: `labels` is `node, component`, `edges` is `a, b` in components.

    Every component with a smaller neighbour takes its smallest one's name, until no edge is left; only local minima
    outlive a round.
    """
    ordered = lambda df: stored_alone(df.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    edges = ordered(edges)
    while not edges.isEmpty():
        parents = stored_alone(edges.groupBy(F.col("b").alias("old")).agg(F.min("a").alias("new")))
        labels = stored_alone(labels.join(parents, labels["component"] == parents["old"], "left").select("node", F.coalesce("new", "component").alias("component")))
        for end in ("a", "b"):
            edges = edges.join(parents, F.col(end) == F.col("old"), "left").withColumn(end, F.coalesce("new", end)).select("a", "b")
        edges = ordered(edges)
    return labels


def _verify(pairs: DataFrame, texts: DataFrame, sketches: DataFrame) -> DataFrame:
    """`a, b, linked`; pairs that their sketches tell apart are left out, before they take their texts along."""
    sides = [sketches.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("cells").alias(f"cells_{end}")) for end in ("a", "b")]
    pairs = stored_alone(pairs.join(sides[0], "a").join(sides[1], "b").mapInArrow(_likely, "a long, b long"))
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = stored_alone(texts.join(ends, "node", "left_semi"))
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return stored_alone(pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b").mapInArrow(_verified, "a long, b long, linked boolean"))


def _merged(checked: DataFrame, labels: DataFrame) -> DataFrame:
    edges = checked.filter("linked")
    for end in ("a", "b"):
        edges = edges.join(labels.withColumnsRenamed({"node": f"node_{end}", "component": f"of_{end}"}), F.col(end) == F.col(f"node_{end}"))
    return contracted(edges.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")), labels)


def set_components(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """`node, component` for each distinct set that shares a signature with another.

    `texts` has `text_key, text`, and `nodes` the key of one text of each set: `node, text_key`.
    """
    n_parts = tasks(texts)
    signed = texts.select("text").mapInArrow(_signed, _SIGNATURES)
    bucket = Window.partitionBy("signature")
    shared = stored_alone(
        signed.select("*", F.min("node").over(bucket).alias("low"), F.max("node").over(bucket).alias("high"), F.count("*").over(bucket).alias("size"))
        .filter("low <> high").select("signature", "node", "size").distinct()
    )
    # The original of a group of copies shares more with each than they share with each other: it meets more sets.
    degrees = stored_alone(shared.groupBy("node").agg(F.sum("size").alias("degree")))
    labels = degrees.select("node", F.col("node").alias("component"))
    shared = shared.select("signature", "node")
    # The texts find their sets by key, without a further pass that hashes their words; copies meet before the join.
    distinct = texts.groupBy("text_key").agg(F.first("text").alias("text"))
    members = stored_alone(distinct.join(nodes.join(labels.select("node"), "node", "left_semi"), "text_key").select("node", "text"))
    sketches = stored_alone(members.mapInArrow(_sketched, "node long, n long, cells binary, coarse binary"))
    done = None
    for _ in range(STAR_ROUNDS):
        rows = shared.join(labels.join(degrees, "node"), "node")
        order = F.struct("degree", F.col("node").alias("node"), F.col("component").alias("component"))
        centred = rows.withColumn("centre", F.max(order).over(bucket)).filter("component <> centre.component")
        offers = centred.groupBy(F.col("node").alias("b"), F.col("centre.node").alias("a")).agg(F.count("*").alias("times"))
        if done is not None:
            offers = offers.join(done.select("a", "b"), ["a", "b"], "left_anti")
        best = offers.groupBy("b").agg(F.max(F.struct("times", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")
        checked = _verify(best, members, sketches)
        labels = _merged(checked, labels)
        done = checked if done is None else done.unionByName(checked)
    rows = shared.join(labels, "node")
    span = rows.select("*", F.min("component").over(bucket).alias("low"), F.max("component").over(bucket).alias("high"))
    open_rows = stored_alone(span.filter("low <> high").select("signature", "node", "component"))
    ordered = bucket.orderBy("n", "node")
    sized = open_rows.join(sketches.select("node", "n"), "node").select("*", F.lag("n").over(ordered).alias("before"), F.lead("n").over(ordered).alias("after"))
    # Sets of no size near another's of their bucket meet none.
    near = sized.filter(f"100 * before >= {LEAST_PERCENT} * n OR 100 * n >= {LEAST_PERCENT} * after").drop("before", "after")
    placed = near.select("*", (F.row_number().over(ordered) - 1).alias("place"), F.count("*").over(bucket).alias("size"))
    blocks = F.sequence(F.lit(0).cast("long"), F.expr(f"(size - 1) div {BLOCK}"))
    dealt = placed.withColumn("own", F.expr(f"place div {BLOCK}")).withColumn("other", F.explode(blocks))
    dealt = dealt.select(
        "signature", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "component", "n",
    )
    # The cells come last, so that one shuffle only has them once for each row.
    dealt = dealt.join(sketches.select("node", F.col("coarse").alias("cells")), "node")
    dealt = dealt.select("signature", "low", "high", "side", "node", "component", "n", "cells")
    dealt = dealt.repartition(n_parts, "signature", "low", "high").sortWithinPartitions("signature", "low", "high")
    pairs = dealt.mapInArrow(_compared, "a long, b long").distinct()
    tried = done.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    checked = _verify(pairs.join(tried, ["a", "b"], "left_anti"), members, sketches)
    return _merged(checked, labels)


def components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, n_shingles, component_id` for each row.

    Words are runs without white space, with A to Z in lower case; a text's set holds its distinct shingles of five words,
    or all of its words as one if there are fewer. Texts with 100 * intersection >= 80 * union are linked, and
    `component_id` is the smallest key that links reach, itself included. Equal sets, repeated rows too, meet before the
    join. Null and empty texts and those without words have no set and are linked with nothing; a null key is never the
    smallest, unless all of its class are null; an empty table gives none. Other columns are not read.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    rows = rows.withColumn("text_key", text_key(F.col("text")))
    described = stored_alone(rows.mapInArrow(_described, _SETS))
    found = described.filter("n_shingles > 0").groupBy("node")
    nodes = found.agg(
        F.min("doc_id").alias("first"), F.min("check").alias("low"), F.max("check").alias("high"), F.min("text_key").alias("text_key")
    )
    nodes = stored_alone(nodes)
    if not nodes.filter("low <> high").isEmpty():
        raise RuntimeError("two different sets have one hash")
    labels = set_components(rows.select("text_key", "text"), nodes.select("node", "text_key"))
    named = nodes.join(labels.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
    named = named.select("node", "first", F.coalesce("component", "node").alias("component"))
    smallest = named.groupBy(F.col("component").alias("_component")).agg(F.min("first").alias("smallest"))
    classes = named.join(smallest, F.col("component") == F.col("_component")).select(F.col("node").alias("_node"), "smallest")
    joined = described.join(classes, (F.col("node") == F.col("_node")) & (F.col("n_shingles") > 0), "left")
    own = F.when(F.col("n_shingles") > 0, F.col("smallest")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", own.alias("component_id"))
