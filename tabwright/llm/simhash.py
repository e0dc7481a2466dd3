"""SimHash fingerprints and near-duplicate components through a Gray-ordered hierarchical index."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest, xxh64_intdigest

from .common import free_name, larger_batches, saved, small_batches

LEAF, FAN = 128, 8
ROWS = 255
LANES = np.uint64(0x0101010101010101)
#: Slots in which shingles are counted to tell common ones from rare ones, sent in pieces.
SLOT_BITS, PIECE = 18, 1 << 12
#: Texts that share a shingle, up to which their pairs are listed; more are searched in blocks.
FEW = 64
#: Rows that a task of the search takes on at a time.
TAKEN = 1 << 15


def remixed(hashes: np.ndarray, k: int | np.ndarray) -> np.ndarray:
    """The ``k``-th further hash of each hash, by a bit mixer; number 0 is the hash itself."""
    if isinstance(k, int) and not k:
        return hashes
    h = hashes + np.asarray(k, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def shingle_hashes(text: bytes, shingle: int, seed: int = 42) -> np.ndarray:
    """Hashes of the runs of ``shingle`` words, of the whole text if it has no more words; none without words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= shingle:
        return np.array([xxh64_intdigest(b" ".join(words), seed)], np.uint64)
    runs = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
    return np.frombuffer(b"".join([xxh64_digest(r, seed) for r in runs]), ">u8").astype(np.uint64)


def wider(hashes: np.ndarray, shingle: int, width: int) -> np.ndarray:
    """The distinct hashes of a text's runs of ``width`` words (of the whole text if it has no more words), mixed from its ``hashes`` of the runs of ``shingle`` <= ``width`` words that cover each."""
    if len(hashes) <= width - shingle + 1:
        return np.array([xxh64_intdigest(hashes.tobytes(), 42)] if len(hashes) else [], np.uint64)
    runs = len(hashes) - (width - shingle)
    total = np.zeros(runs, np.uint64)
    for i, at in enumerate(sorted({*range(0, width - shingle, shingle), width - shingle})):
        total += hashes[at : at + runs] * np.uint64((2 * i + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    return np.unique(remixed(total, 1))


def fingerprint(text: bytes, shingle: int = 3, prints: int = 1, seed: int = 42) -> np.ndarray:
    """``prints`` numbers of 64 bits: bit b is set if over half of the text's shingle hashes have it; zero without words."""
    return majorities(shingle_hashes(text, shingle, seed), prints)


def majorities(hashes: np.ndarray, prints: int) -> np.ndarray:
    """The fingerprints of a text's shingle hashes."""
    if not len(hashes):
        return np.zeros(prints, np.uint64)
    total = np.zeros((prints, 64), np.int64)
    for at in range(0, len(hashes), ROWS * 16):
        piece = hashes[at : at + ROWS * 16]
        rows = np.zeros((prints, -(-len(piece) // ROWS) * ROWS), np.uint64)
        rows[0, : len(piece)] = piece
        rows[1:, : len(piece)] = remixed(piece, np.arange(1, prints, dtype=np.uint64)[:, None])
        bits = (rows.reshape(prints, 1, -1, ROWS) >> np.arange(8, dtype=np.uint64)[:, None, None]) & LANES
        lanes = bits.sum(axis=3).view(np.uint8)  # bit b of each byte, counted in that byte: as many rows as it can count
        total += lanes.reshape(prints, 8, -1, 8).sum(axis=2, dtype=np.int64).transpose(0, 2, 1).reshape(prints, 64)
    return np.packbits(2 * total > len(hashes), axis=1, bitorder="little").view(np.uint64)[:, 0]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, prints: int = 1) -> DataFrame:
    """Rows (``__id``, ``fps`` array of long: each 64 bits as a signed number), one for each document; a null text is empty."""
    small_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"__id": b["__id"], "fps": [fingerprint(b"" if t is None else bytes(t), shingle, prints).view(np.int64) for t in b["__text"]]})

    return docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("binary").alias("__text")).mapInPandas(run, f"__id {kind}, fps array<long>")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray order; codes with equal leading bits stay together."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _levels(codes: np.ndarray, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    """For each level from the leaves up: pattern and mask of the bits that all codes of a node share, its smallest and largest size, and codes a node."""
    levels, step = [], LEAF
    at = np.arange(0, len(codes), LEAF)
    low, high, small, large = np.bitwise_and.reduceat(codes, at), np.bitwise_or.reduceat(codes, at), np.minimum.reduceat(sizes, at), np.maximum.reduceat(sizes, at)
    while True:
        mask = ~(low ^ high)
        levels.append((low & mask, mask, small, large, step))
        if len(low) <= FAN:
            return levels
        at = np.arange(0, len(low), FAN)
        low, high, step = np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at), step * FAN
        small, large = np.minimum.reduceat(small, at), np.maximum.reduceat(large, at)


def index_links(codes: np.ndarray, radius: int, sizes: np.ndarray | None = None, least: float = 0.0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All links of ``radius`` or fewer differing bits between codes (uint64), in blocks (members, queries, which query is near which member) of positions.

    The codes, in Gray order, are leaves of a tree whose nodes hold the bits that their codes share. A search goes down with all
    codes at once: a child adds the differences in the bits that its parent left open, and codes with more than ``radius`` are dropped with the whole group below.
    With ``sizes`` only codes link of which the smaller size is ``least`` of the larger or more: the order is by classes of such sizes first, nodes hold the range of theirs,
    and queries of a larger or a far smaller size are dropped, so each link is given once, with the larger size as the member.
    """
    if len(codes) <= 2 * LEAF:
        everyone = np.arange(len(codes))
        near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= radius
        yield everyone, everyone, near if sizes is None else near & (np.minimum(sizes[:, None], sizes[None, :]) >= least * np.maximum(sizes[:, None], sizes[None, :]) - 1e-9)
        return
    held = np.zeros(len(codes)) if sizes is None else sizes
    order = np.argsort(gray_rank(codes), kind="stable")
    if sizes is not None:
        order = order[np.argsort(np.floor(np.log(np.maximum(held[order], 1)) / -np.log(least)), kind="stable")]
    codes, held = codes[order], held[order]
    levels = _levels(codes, held)
    top = len(levels) - 1
    stack = [(top, i, np.arange(len(codes)), np.zeros(len(codes), np.int16), np.uint64(0)) for i in range(len(levels[top][0]))]
    while stack:
        level, i, queries, apart, known = stack.pop()
        pattern, mask, small, large, step = levels[level]
        if sizes is not None:
            fits = (held[queries] <= large[i]) & (held[queries] >= least * small[i] - 1e-9)
            queries, apart = queries[fits], apart[fits]
        apart = apart + np.bitwise_count((codes[queries] ^ pattern[i]) & (mask[i] & ~known))
        stays = apart <= radius
        queries, apart = queries[stays], apart[stays]
        if not len(queries):
            continue
        if level:
            stack += [(level - 1, k, queries, apart, mask[i]) for k in range(i * FAN, min((i + 1) * FAN, len(levels[level - 1][0])))]
        else:
            members = np.arange(i * step, min((i + 1) * step, len(codes)))
            open_bits = ~mask[i]
            for at in range(0, len(queries), 4096):
                q = queries[at : at + 4096]
                near = apart[at : at + 4096, None] + np.bitwise_count((codes[q][:, None] ^ codes[members][None, :]) & open_bits) <= radius
                if sizes is not None:
                    hit, to = np.nonzero(near)
                    wrong = (held[q[hit]] > held[members[to]]) | (held[q[hit]] < least * held[members[to]] - 1e-9)
                    near[hit[wrong], to[wrong]] = False
                some = near.any(axis=0)
                yield order[members[some]], order[q], near[:, some]


def components(codes: np.ndarray, radius: int, sizes: np.ndarray | None = None, least: float = 0.0) -> np.ndarray:
    """Component number of each code (distinct, uint64; not so with ``sizes``) under links of ``radius`` or fewer differing bits, and of sizes that differ by a factor of ``least`` at most."""
    root = np.arange(len(codes))
    for members, queries, near in index_links(codes, radius, sizes, least):
        at, to = np.nonzero(near)
        a, b = root[queries[at]], root[members[to]]
        while (apart := a != b).any():
            a, b = a[apart], b[apart]
            hook = np.arange(len(codes))
            np.minimum.at(hook, np.maximum(a, b), np.minimum(a, b))
            while (after := hook[hook]).tobytes() != hook.tobytes():
                hook = after
            root, a, b = hook[root], hook[a], hook[b]
    return root


def chains(codes: np.ndarray, nodes: np.ndarray, radius: int, sizes: np.ndarray | None = None, least: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Links that hold each component together: every node to the next of its component, so that no node has more than two."""
    if sizes is None:
        distinct, at = np.unique(codes, return_inverse=True)
        label = components(distinct, radius)[at]
    else:
        label = components(codes, radius, sizes, least)
    order = np.lexsort((nodes, label))
    same = (label[order][1:] == label[order][:-1]) & (nodes[order][1:] != nodes[order][:-1])
    return nodes[order][:-1][same], nodes[order][1:][same]


def links(nodes: DataFrame, radius: int = 3, unit: int = 4096, least: float | None = None) -> DataFrame:
    """Links (``a``, ``b``) that connect the components of (``node``, ``fps``): nodes link if a fingerprint of both is within ``radius`` bits.

    With ``least`` only nodes link of which the smaller ``n`` is that share of the larger or more.

    Two fingerprints within ``radius`` agree in one of ``radius + 1`` blocks of bits, so each goes once to the run of each of its blocks'
    values; a run, whose fingerprints share that block, is searched by the index of ``components``. A run of
    more than ``unit`` is dealt into p parts at random and each pair of parts is one search, so a run that holds a large share of all rows becomes many tasks of at most
    about 2 x ``unit`` fingerprints. All of it is exact; links inside a component beyond a chain are not listed.
    """
    width = 64 // (radius + 1)
    spans = [(i, 64 if i == radius else width * (i + 1), width * i) for i in range(radius + 1)]
    sizes = nodes["n"].cast("int") if least is not None else F.lit(0)
    each = nodes.select("node", sizes.alias("n"), F.posexplode("fps").alias("print", "fp"))
    keys = F.array(*[F.struct((F.col("print") * 64 + i).alias("block"), F.shiftrightunsigned(F.shiftleft("fp", 64 - hi), 64 - hi + lo).alias("value")) for i, hi, lo in spans])
    runs = each.select("node", "n", "fp", F.explode(keys).alias("k")).select("node", "n", "fp", "k.block", "k.value")
    large = runs.groupBy("block", "value").agg(F.count("*").alias("rows")).filter(F.col("rows") > unit).select("block", "value", F.ceil(F.col("rows") / unit).alias("parts"))
    runs = runs.join(large, ["block", "value"], "left")
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda other: F.least(part, other) * F.col("parts") + F.greatest(part, other))
    units = runs.select("node", "n", "fp", "block", "value", F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(pairs)).alias("pair"))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        taken, rows = [], 0
        for b in batches:
            taken, rows = [*taken, b], rows + len(b)
            if rows < TAKEN:
                continue
            b = pd.concat(taken, ignore_index=True)
            cuts = changes(b)
            last = cuts[-1] if len(cuts) else 0
            yield found(b[:last], cuts[:-1])
            taken, rows = [b[last:]], 0  # a run's rest is looked at again when as much has come
        if taken:
            b = pd.concat(taken, ignore_index=True)
            yield found(b, changes(b))

    def changes(b: pd.DataFrame) -> np.ndarray:
        return np.flatnonzero(np.logical_or.reduce([b[c].to_numpy()[1:] != b[c].to_numpy()[:-1] for c in ("block", "value", "pair")])) + 1

    def found(b: pd.DataFrame, cuts: np.ndarray) -> pd.DataFrame:
        fp, node, n = b.fp.to_numpy(), b.node.to_numpy(), b.n.to_numpy()
        edges = np.concatenate([[0], cuts, [len(fp)]]).astype(int)
        many = np.flatnonzero(np.diff(edges) > 1)
        of = lambda x, i: np.ascontiguousarray(x[edges[i] : edges[i + 1]])
        got = [chains(of(fp, i).view(np.uint64), of(node, i), radius, *((of(n, i), least) if least is not None else ())) for i in many]
        return pd.DataFrame({"a": np.concatenate([np.zeros(0, np.int64), *(g[0] for g in got)]), "b": np.concatenate([np.zeros(0, np.int64), *(g[1] for g in got)])})

    dealt = units.repartition("block", "value", "pair").sortWithinPartitions("block", "value", "pair")
    with larger_batches(nodes.sparkSession):
        return saved(dealt.mapInPandas(search, "a long, b long").distinct(), "found")


def spread(edges: DataFrame) -> DataFrame:
    """Rows (``node``, ``root``): the smallest node that each node of ``edges`` (``a``, ``b``) reaches.

    The links, whose nodes have few links each, are joined once with the first labels of both ends; from there on they are links between labels, of which each
    round keeps those of different labels, once. A round hooks every label to the smallest one beside it and follows the hooks; labels only fall, and the rounds end
    when no links are left. Each round's labels are written to the shared folder.
    """
    edges = saved(edges, "links")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels")
    left = labels.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    right = labels.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    ends = edges.join(left, "a").join(right, "b").select("ra", "rb")
    while True:
        ends = saved(ends.filter("ra != rb").select(F.least("ra", "rb").alias("ra"), F.greatest("ra", "rb").alias("rb")).distinct(), "ends")
        if ends.isEmpty():
            return labels
        hooks = saved(ends.groupBy(F.col("rb").alias("root")).agg(F.min("ra").alias("to")), "hooks")
        for _ in range(2):
            onward = hooks.select(F.col("root").alias("to"), F.col("to").alias("__on"))
            hooks = hooks.join(onward, "to", "left").select("root", F.coalesce("__on", "to").alias("to"))
        hooks = saved(hooks, "hooked")
        labels = saved(labels.join(hooks, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "labels")
        for end in ("ra", "rb"):
            ends = ends.join(hooks.withColumnsRenamed({"root": end, "to": "__to"}), end, "left").withColumn(end, F.coalesce("__to", end)).drop("__to")


def grouped(prints: DataFrame, key: str, radius: int) -> DataFrame:
    """Rows (``fps``, ``first``) for each list of fingerprints: the smallest ``key`` that it reaches; null keys come last.

    A node is the fingerprint, or of several a hash of 64 bits.
    """
    node = F.when(F.size("fps") == 1, F.get("fps", 0)).otherwise(F.xxhash64("fps"))
    nodes = saved(prints.groupBy("fps").agg(F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"))).alias("least")).withColumn("node", node), "nodes")
    linked = saved(nodes.select("node", "least").join(spread(links(nodes.select("node", "fps"), radius)), "node"), "linked")
    smallest = linked.groupBy("root").agg(F.min("least").alias("first"))
    found = linked.join(smallest, "root").select("node", "first")
    return saved(nodes.join(found, "node", "left").select("fps", F.coalesce("first", "least")["key"].alias("first")), "groups")


def near_duplicates(docs: DataFrame, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, ``fingerprint``, ``component_id``), one for each document.

    Documents with one fingerprint are one node; links join nodes at ``radius`` or fewer differing bits. ``component_id`` is the smallest id that the document
    reaches, itself included (null if no document there has an id). Null and empty texts have fingerprint zero and link like any other;
    repeated rows are each returned; an empty table gives no rows.
    """
    prints = saved(fingerprints(docs, id_col, text_col), "fingerprints")
    named = grouped(prints, "__id", radius).select("fps", F.col("first").alias("component_id"))
    return prints.join(named, "fps").select(F.col("__id").alias(id_col), F.lower(F.lpad(F.hex(F.get("fps", 0)), 16, "0")).alias("fingerprint"), "component_id")


def similar(sets: list[np.ndarray], least: float, fps: np.ndarray | None = None, radius: int = 0, known: np.ndarray | None = None) -> np.ndarray:
    """Component number of each set (of distinct hashes) under links of Jaccard ``least`` or more; sets of one number in ``known`` hold together from the start.

    With ``fps`` (a row of fingerprints, uint64, for each set) only sets link of which the index finds a fingerprint within ``radius`` bits; without, any two. Each
    link is compared on the whole sets, once, unless its ends hold together already, so a group of near copies costs about one pass over it.
    """
    sizes = np.array([len(x) for x in sets], np.int64)
    ids = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True)[1]
    starts = np.cumsum(sizes) - sizes
    mark = np.zeros(len(ids) + 1, bool)
    label = np.arange(len(sets))
    if known is not None:
        _, first, at = np.unique(known, return_index=True, return_inverse=True)
        label = first[at]

    def near_ones(m: int, some: np.ndarray) -> np.ndarray:
        own = ids[starts[m] : starts[m] + sizes[m]]
        ends = np.cumsum(sizes[some])
        mark[own] = True
        running = np.concatenate([[0], np.cumsum(mark[ids[np.arange(ends[-1]) + np.repeat(starts[some] - ends + sizes[some], sizes[some])]])])
        mark[own] = False
        both = running[ends] - running[ends - sizes[some]]
        return some[both >= least * (sizes[some] + sizes[m] - both) - 1e-9]

    def linked() -> Iterator[tuple[int, np.ndarray]]:
        if fps is None:
            yield from ((m, np.arange(m + 1, len(sets))) for m in range(len(sets)))
            return
        for k in range(fps.shape[1]):
            for members, queries, near in index_links(np.ascontiguousarray(fps[:, k]), radius):
                near = near & (queries[:, None] > members[None, :]) & (label[queries][:, None] != label[members][None, :])
                for j in np.flatnonzero(near.any(axis=0)):
                    m, some = members[j], queries[near[:, j]]
                    yield m, some[(np.bitwise_count(fps[some, :k] ^ fps[m, :k]) > radius).all(axis=1)]  # else compared already

    for m, some in linked():
        some = some[(label[some] != label[m]) & (np.minimum(sizes[some], sizes[m]) >= least * np.maximum(sizes[some], sizes[m]) - 1e-9)]
        if len(some) and len(some := near_ones(m, some)):
            labels = np.union1d(label[some], label[m : m + 1])
            label[np.isin(label, labels)] = labels[0]
    return label


def verified(members: DataFrame, least: float, unit: int = 1 << 21, radius: int | None = None) -> DataFrame:
    """Links (``a``, ``b``) of Jaccard ``least`` or more that hold together the components of (``node``, ``family``, ``shingles``) inside each family.

    With ``radius`` the links are those of the index on ``fps``: two nodes with a fingerprint of both within ``radius`` bits, each compared on the whole shingle
    sets; without, all pairs of a family. Nodes of one ``label``, if there is that column, hold together already. A family of more than ``unit`` shingles or 4,096 nodes is dealt into parts at random and each pair of
    parts is one search, so that a task holds about 2 x ``unit`` shingles however large the family is.
    """
    weight = F.size("shingles") + F.lit(unit / 4096)
    large = members.groupBy("family").agg(F.sum(weight).alias("n")).filter(F.col("n") > unit).select("family", F.ceil(F.col("n") / unit).alias("parts"))
    part = F.pmod(F.xxhash64("node", F.lit("part")), F.col("parts"))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda other: F.least(part, other) * F.col("parts") + F.greatest(part, other))
    units = members.join(large, "family", "left")
    fps = F.array().cast("array<long>") if radius is None else F.col("fps")
    units = units.select("family", F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(pairs)).alias("pair"), "node", fps.alias("fps"), "shingles", F.col("label" if "label" in members.columns else "node").alias("label"))

    def chained(rows: list[tuple[int, np.ndarray, np.ndarray, int]]) -> list[tuple[int, int]]:
        prints = None if radius is None else np.array([p for _, p, _, _ in rows], np.int64).view(np.uint64)
        label = similar([np.asarray(x, np.int64).view(np.uint64) for _, _, x, _ in rows], least, prints, radius or 0, np.array([k for _, _, _, k in rows]))
        return [(rows[i][0], rows[k][0]) for i, k in enumerate(label) if i != k]

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, rows = None, []
        for b in batches:
            out = []
            for family, pair, node, prints, shingles, known in zip(b.family, b.pair, b.node, b.fps, b.shingles, b.label, strict=True):
                if at != (family, pair):
                    out += chained(rows) if len(rows) > 1 else []
                    at, rows = (family, pair), []
                rows.append((node, prints, shingles, known))
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")
        if len(rows) > 1:
            yield pd.DataFrame(chained(rows), columns=["a", "b"], dtype="int64")

    dealt = units.repartition("family", "pair").sortWithinPartitions("family", "pair")
    return dealt.mapInPandas(search, "a long, b long").distinct()


def shingle_set(text: bytes | None, shingle: int, width: int) -> np.ndarray:
    return wider(shingle_hashes(b"" if text is None else bytes(text), shingle), shingle, width)


def set_id(hashes: np.ndarray) -> int:
    """The node of a shingle set."""
    return int(np.uint64(xxh64_intdigest(hashes.tobytes(), 42)).view(np.int64))


def rarest(hashes: np.ndarray, counts: np.ndarray, least: float) -> np.ndarray:
    """The n - ceil(``least`` n) + 1 of n hashes that come first by the count of their slot: of two sets of Jaccard ``least`` or more both have one of them in common."""
    order = np.lexsort((hashes, counts[hashes >> np.uint64(64 - SLOT_BITS)]))
    return hashes[order[: len(hashes) - math.ceil(least * len(hashes) - 1e-9) + 1]]


def slot_counts(pieces: DataFrame) -> np.ndarray:
    """The sums of the tasks' counts of shingles by slot, from rows (``piece``, ``counts``); as many numbers whatever the input."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for piece, counts in zip(b.piece, b.counts, strict=True):
                total[piece] = total.get(piece, 0) + np.asarray(counts, np.int64)
        yield pd.DataFrame({"piece": list(total), "counts": list(total.values())})

    out = np.zeros(1 << SLOT_BITS, np.int64)
    for r in pieces.repartition("piece").mapInPandas(add, "piece int, counts array<long>").collect():
        out[r.piece * PIECE : (r.piece + 1) * PIECE] = r.counts
    return out


def missed_links(placed: DataFrame, roots: DataFrame, sets_of, least: float) -> DataFrame:
    """Links (``a``, ``b``) of Jaccard ``least`` or more between nodes of different ``root``, enough to hold together what belongs together.

    ``placed`` has (``node``, ``n``, ``first``): a set's size and the shingles of ``rarest``, of which two such sets share one. Where a shingle is shared by up to ``FEW`` sets their pairs are listed, without
    those that sizes or places rule out, and each is counted once on the whole sets, which ``sets_of`` gives for nodes; a shingle of more is a family, all pairs of
    which are searched in blocks.
    """
    rows = placed.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("label"), "n", F.posexplode("first").alias("at", "token"))
    shared = rows.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("held")).filter("low != high").select("token", "held")
    runs = saved(rows.join(saved(shared, "shared"), "token"), "runs")
    few, many = runs.filter(F.col("held") <= FEW), runs.filter(F.col("held") > FEW)
    a, b = (few.select("token", *[F.col(c).alias(f"{c}_{end}") for c in ("node", "label", "n", "at")]) for end in "ab")
    # The first shingle that both have has no more in common behind it than the shorter rest.
    rest = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    able = (F.col("label_a") < F.col("label_b")) & (rest >= least / (1 + least) * (F.col("n_a") + F.col("n_b")) - 1e-6)
    pairs = saved(a.join(b, "token").filter(able).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct(), "pairs")
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).unionByName(many.select("node")).distinct()
    sets = saved(sets_of(wanted), "sets")
    end = lambda name: sets.select(F.col("node").alias(name), F.col("shingles").alias(f"of_{name}"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    counted = pairs.join(end("a"), "a").join(end("b"), "b").select("a", "b", both.alias("both"), (F.size("of_a") + F.size("of_b")).alias("n"))
    hold = counted.filter(F.col("both") >= least * (F.col("n") - F.col("both")) - 1e-9).select("a", "b")
    return hold.unionByName(verified(many.select("node", "label", F.col("token").alias("family")).join(sets, "node"), least)).distinct()


def deduplicated(docs: DataFrame, radius: int = 7, prints: int = 8, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8, width: int = 5, whole: bool = False) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, and of several such rows one; a component without any id keeps a row too.

    Texts link if any of their ``prints`` fingerprints differ in ``radius`` or fewer bits, as the index finds, and the Jaccard similarity of their distinct
    ``width``-word shingles is ``least`` or more; links carry over. Every link of the index is checked exactly, one text standing for all of its shingle set; texts that
    reach each other by unchecked links are a family, by which the checks are dealt out. With ``whole`` all texts of that similarity link: those whose
    fingerprints are further apart are found by their rarest shingles, between the components so far. Null and empty texts are one group.
    """
    small_batches(docs.sparkSession)
    narrow = min(shingle, width)
    text = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    keyed = docs.select(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), text.alias("t")).alias("__key"), F.col(text_col).cast("binary").alias("__text"))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(1 << SLOT_BITS, np.int32)
        for b in batches:
            hashes = [shingle_hashes(b"" if t is None else bytes(t), narrow) for t in b["__text"]]
            sets = [wider(x, narrow, width) for x in hashes]
            if whole:
                np.add.at(counts, np.concatenate(sets) >> np.uint64(64 - SLOT_BITS), 1)
            yield pd.DataFrame({"none": b["none"], "id": b["id"], "t": b["t"], "node": [set_id(x) for x in sets], "n": [len(x) for x in sets], "fps": [majorities(x, prints).view(np.int64) for x in (hashes if narrow == shingle else [shingle_hashes(b"" if t is None else bytes(t), shingle) for t in b["__text"]])], "piece": None, "counts": None})
        if counts.any():
            yield pd.DataFrame({"none": None, "id": None, "t": None, "node": None, "n": None, "fps": None, "piece": range(len(counts) // PIECE), "counts": list(counts.reshape(-1, PIECE))})

    def shingled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.drop(columns="__text").assign(shingles=[shingle_set(t, narrow, width).view(np.int64) for t in b["__text"]])

    def with_shingles(wanted: DataFrame, schema: str) -> DataFrame:
        """``wanted`` (``node``, more, of ``schema``) with the ``shingles`` of the text that stands for each node."""
        given = wanted.join(nodes.select("node", F.col("least.none").alias("__n"), F.col("least.id").alias("__i"), F.col("least.t").alias("__t")), "node")
        same = keyed.select("__key.*", "__text").join(given, (F.col("t") == F.col("__t")) & F.col("id").eqNullSafe(F.col("__i")))
        return same.dropDuplicates(["node"]).select(*wanted.columns, "__text").mapInPandas(shingled, f"{schema}, shingles array<long>")

    flat = f"none boolean, id {dict(docs.dtypes)[id_col]}, t long"
    found = saved(keyed.select("__key.*", "__text").mapInPandas(hashed, f"{flat}, node long, n int, fps array<long>, piece int, counts array<int>"), "hashed")
    nodes = saved(found.filter("node is not null").groupBy("node").agg(F.min(F.struct("none", "id", "t")).alias("least"), F.any_value("n").alias("n"), F.min("fps").alias("fps")), "nodes")
    families = spread(links(nodes.select("node", "n", "fps"), radius, least=least)).select("node", F.col("root").alias("family"))
    members = saved(with_shingles(nodes.select("node", "fps").join(families, "node").select("node", "family", "fps"), "node long, family long, fps array<long>"), "shingles")
    linked = verified(members, least, radius=radius)
    roots = spread(linked)
    if whole:
        counts = slot_counts(found.filter("piece is not null").select("piece", "counts"))

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                sets = [shingle_set(t, narrow, width) for t in b["__text"]]
                yield pd.DataFrame({"node": [set_id(x) for x in sets], "n": [len(x) for x in sets], "first": [rarest(x, counts, least).view(np.int64) for x in sets]})

        placed = saved(keyed.select("__text").mapInPandas(place, "node long, n int, first array<long>").dropDuplicates(["node"]), "placed")
        more = saved(missed_links(placed, roots, lambda wanted: with_shingles(wanted, "node long"), least), "missed")
        if not more.isEmpty():
            chains = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
            roots = spread(chains.unionByName(more))
    labelled = saved(nodes.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "labelled")
    h, first_id, first_text = (free_name(docs, x) for x in ("h_", "id_", "t_"))
    kept = labelled.groupBy("root").agg(F.min("least").alias("first")).select(F.col("first.id").alias(first_id), F.col("first.t").alias(first_text))
    rows = docs.withColumns({h: text}).join(kept, F.col(id_col).eqNullSafe(F.col(first_id)) & (F.col(h) == F.col(first_text)))
    return rows.dropDuplicates([first_id, first_text]).select(*[docs[f"`{c}`"] for c in docs.columns])
