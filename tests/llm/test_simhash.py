import random

import numpy as np
from xxhash import xxh64_intdigest

import corpus_pipeline
from tabwright.llm import simhash


def brute_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    h = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    """Smallest id reached by each (id, print) at 3 or fewer differing bits."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(prints):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return [least.get(find(i)) for i in range(len(prints))]


def check(df, rows):
    prints = [(i, brute_print(t)) for i, t in rows]
    want = sorted(((i, f"{p:016x}", c) for (i, p), c in zip(prints, brute_components(prints), strict=True)), key=str)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == want


def test_documents_against_brute_force(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    check(df, [(r.doc_id, r.text) for r in df.collect()])


def test_corner_cases(spark, docs_of):
    rng = random.Random(3)
    base = [rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(400)]
    rows = [(50, None), (51, ""), (52, " \t\n"), (1, "Word"), (2, "word"), (3, "two words"), (3, "two words"), (None, "two words"), (None, "lonely text without a number"), (60, "x " * 30_000)]
    for i in range(100, 130):
        w = list(base)
        w[rng.randrange(400)] = "edit"
        rows.append((i, " ".join(w)))
    check(docs_of(rows, ", fp long, root string"), rows)
    assert simhash.near_duplicates(docs_of([])).collect() == []


def test_index_against_all_pairs():
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    codes = set(rng.integers(0, 1 << 63, 300, dtype=np.uint64).tolist())
    for c in centres.tolist():
        for _ in range(25):
            for b in rng.integers(0, 64, rng.integers(0, 5)):
                c ^= 1 << int(b)
            codes.add(c)
    codes = np.array(sorted(codes), np.uint64)
    rng.shuffle(codes)
    label = simhash.components(codes, 3)
    want = brute_components(list(enumerate(codes.tolist())))
    assert len(set(zip(label.tolist(), want, strict=True))) == len(set(want)) == len(set(label.tolist()))


def test_large_runs_are_dealt_out(spark):
    rng = np.random.default_rng(6)
    codes = {int(x) & 0xFFFF_FFFF | 0x1234_5678 << 32 for x in rng.integers(0, 1 << 62, 500)}
    for c in list(codes)[:200]:
        codes.add(c ^ (1 << int(rng.integers(0, 30))) ^ (1 << int(rng.integers(0, 30))))
    codes = sorted(codes)
    signed = [int(np.uint64(c).view(np.int64)) for c in codes]
    df = spark.createDataFrame([(c, [c]) for c in signed], "node long, fps array<long>")
    want = brute_components(list(enumerate(codes)))
    for unit in (64, 4096):
        found = {r.node: r.root for r in simhash.spread(simhash.links(df, 3, unit)).collect()}
        label = [found.get(int(np.uint64(c).view(np.int64)), int(np.uint64(c).view(np.int64))) for c in codes]
        assert len(set(zip(label, want, strict=True))) == len(set(want)) == len(set(label))


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(500)], "a long, b long")
    assert {r.root for r in simhash.spread(edges).collect()} == {0}


def test_deduplicated_keeps_one_of_each_group(spark, docs_of):
    text = "one two three four five six seven eight nine ten"
    rows = [(3, text), (2, text), (2, text), (9, "quite another text of its own with some words"), (None, None), (5, ""), (None, "a text without any number at all in it")]
    got = sorted(((r.doc_id, r.text) for r in simhash.deduplicated(docs_of(rows, ", fp long, least int")).collect()), key=str)
    assert got == sorted([(2, text), (9, rows[3][1]), (5, ""), (None, rows[6][1])], key=str)


def test_edited_copies_are_one_group(spark, sf):
    """Of pairs of different texts whose five-word shingles agree to 0.8 (found by brute force) nearly all are one group."""
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet").dropDuplicates(["text"])
    texts = {r.doc_id: r.text.lower().split() for r in docs.collect()}
    sets = {i: {tuple(w[j : j + 5]) for j in range(max(len(w) - 4, 1))} for i, w in texts.items()}
    ids = sorted(sets)
    near = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if 0.8 <= len(sets[a]) / len(sets[b]) <= 1.25 and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    kept = {r.doc_id for r in simhash.deduplicated(docs).collect()}
    assert near and sum(not (a in kept and b in kept) for a, b in near) >= 0.95 * len(near)
    shared = {i for i in ids if all(len(sets[i] & sets[j]) < 0.3 * len(sets[i] | sets[j]) for j in ids if j != i)}
    assert shared <= kept


def test_less_similar_texts_stay(spark, docs_of):
    """Texts of five-word similarity 0.5 to 0.79 stay, those of 0.8 and more go, however near their fingerprints are; a family may be dealt into parts."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9)))
    rows, sets, stays, goes = [], {}, 0, 0
    for g in range(30):
        base = [word() for _ in range(300)]
        edited = list(base)
        for at in range(7, 7 + 15 * (2 + g % 8), 15):
            edited[at] = word()
        for i, w in ((2 * g, base), (2 * g + 1, edited)):
            rows.append((i, " ".join(w)))
            sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)}
    kept = {r.doc_id for r in simhash.deduplicated(docs_of(rows), radius=12).collect()}
    for g in range(30):
        a, b = sets[2 * g], sets[2 * g + 1]
        share = len(a & b) / len(a | b)
        assert 2 * g in kept and (2 * g + 1 in kept) == (share < 0.8)
        stays, goes = stays + (0.5 <= share < 0.8), goes + (share >= 0.8)
    assert stays > 5 and goes > 5


def test_verified_links_against_all_pairs(spark):
    rng = random.Random(9)
    bases = [rng.sample(range(1 << 40), 60) for _ in range(8)]
    sets = [sorted(set(rng.choice(bases)[rng.randint(0, 9) :]) | {rng.randrange(1 << 40) for _ in range(rng.randint(0, 9))}) for _ in range(150)]
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if len(set(a) & set(sets[j])) >= 0.8 * len(set(a) | set(sets[j])):
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    df = spark.createDataFrame([(i, 0, x) for i, x in enumerate(sets)], "node long, family long, shingles array<long>")
    for unit in (1000, 1 << 21):
        label = {r.node: r.root for r in simhash.spread(simhash.verified(df, 0.8, unit)).collect()}
        got = [label.get(i, i) for i in range(len(sets))]
        assert len(set(zip(got, root, strict=True))) == len(set(root)) == len(set(got))


def edited(rng, base, word, most):
    """``base`` with up to ``most`` words changed, a run of words replaced or words added at its end."""
    out = list(base)
    kind = rng.randrange(3)
    n = rng.randint(1, most)
    if kind == 0:
        for at in rng.sample(range(len(out)), n):
            out[at] = word()
    elif kind == 1:
        at = rng.randrange(len(out) - n)
        out[at : at + n] = [word() for _ in range(n)]
    else:
        out += [word() for _ in range(2 * n)]
    return out


def test_links_of_the_index_are_checked_one_by_one(spark, docs_of):
    """Components of exactly the pairs that have both a fingerprint within the radius and similar shingles, in groups whose texts reach each other by other links."""
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9)))
    texts = []
    for _ in range(12):
        group = [[word() for _ in range(rng.randint(60, 120))]]
        group += [edited(rng, rng.choice(group), word, 3) for _ in range(11)]
        texts += group
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    sets = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in texts]
    prints = [simhash.fingerprint(t.encode(), 3, 2) for _, t in rows]
    near = lambda i, j: (np.bitwise_count(prints[i] ^ prints[j]) <= 5).any()
    alike = lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])

    def grouped(linked):
        root = list(range(len(rows)))
        for i in range(len(rows)):
            for j in range(i):
                if root[i] != root[j] and linked(i, j):
                    low, high = sorted((root[i], root[j]))
                    root = [low if r == high else r for r in root]
        return root

    family = grouped(near)
    want = set(grouped(lambda i, j: near(i, j) and alike(i, j)))
    assert want != set(grouped(lambda i, j: family[i] == family[j] and alike(i, j)))
    assert {r.doc_id for r in simhash.deduplicated(docs_of(rows), radius=5, prints=2).collect()} == want


def test_checked_links_against_brute_force():
    """Links of several fingerprints on many sets, so that the index is a tree of levels; copies of a fingerprint have different sets."""
    rng = np.random.default_rng(14)
    bases = [rng.choice(1 << 40, 60, replace=False) for _ in range(30)]
    centres = rng.integers(0, 1 << 63, (30, 3), dtype=np.uint64)
    sets, fps = [], []
    for i in range(600):
        g = int(rng.integers(30))
        sets.append(np.unique(np.concatenate([bases[g][rng.integers(0, 9) :], rng.choice(1 << 40, rng.integers(0, 9))])).astype(np.uint64))
        fps.append([int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for c in centres[g]])
    fps = np.array(fps, np.uint64)
    held = [set(x.tolist()) for x in sets]
    want = np.arange(len(sets))
    for i in range(len(sets)):
        for j in range(i):
            if (np.bitwise_count(fps[i] ^ fps[j]) <= 3).any() and len(held[i] & held[j]) >= 0.8 * len(held[i] | held[j]):
                want[want == want[j]] = want[i]
    got = simhash.similar(sets, 0.8, fps, 3)
    assert 30 < len(set(got.tolist())) == len(set(want.tolist())) == len(set(zip(got.tolist(), want.tolist(), strict=True)))


def test_pairs_of_little_over_the_least_similarity_are_found(spark, docs_of):
    rng = random.Random(15)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9)))
    rows = []
    while len(rows) < 400:
        base = [word() for _ in range(rng.randint(45, 150))]
        other = edited(rng, base, word, 8)
        a, b = ({tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in (base, other))
        if 0.8 <= len(a & b) / len(a | b) <= 0.9:
            rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(other))]
    kept = {r.doc_id for r in simhash.deduplicated(docs_of(rows)).collect()}
    assert {i for i in range(0, 400, 2)} <= kept and len(kept) <= 200 + 4


def test_labels_of_random_links(spark, monkeypatch):
    """Smallest node of each component, self links and links both ways; the links themselves are written once, later rounds hold fewer."""
    rng = random.Random(16)
    edges = [(i, rng.randrange(i)) for i in range(1, 300)] + [(1000 + i, 1000 + rng.randrange(2000)) for i in range(1500)] + [(5, 5), (9000, 9001), (9001, 9000)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    sizes, real = [], simhash.saved
    monkeypatch.setattr(simhash, "saved", lambda df, name: (out := real(df, name), sizes.append(out.count()) if name == "ends" else None)[0])
    got = {r.node: r.root for r in simhash.spread(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert sizes and sizes[0] < len(edges) and sizes[-1] == 0 and all(b < a for a, b in zip(sizes, sizes[1:]))


def exact_groups(sets, least=0.8):
    """Smallest position that each set reaches by links of Jaccard ``least`` or more, by comparing all pairs."""
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if root[i] != root[j] and len(a & sets[j]) >= least * len(a | sets[j]) - 1e-9:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root


def test_whole_finds_every_similar_pair(spark, docs_of, monkeypatch):
    """With one fingerprint that must be equal the index misses most pairs; ``whole`` finds all of them, in lists or in blocks, and no other. A line that many texts share links none."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9)))
    line, texts = [word() for _ in range(12)], [["one"], ["one", "two"], ["two", "one"], [], list("abcde"), list("abcdef"), list("abcdefghi"), list("abcdefghij")]
    for g in range(60):
        base = ([*line] if g % 2 else []) + [word() for _ in range(rng.randint(8, 120))]
        texts += [base, edited(rng, base, word, 3), edited(rng, base, word, 3)]
    group = [[word() for _ in range(100)]]
    texts += group + [edited(rng, group[0], word, 4) for _ in range(40)]
    rng.shuffle(texts)
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    sets = [{tuple(w[j : j + 5]) for j in range(max(len(w) - 4, min(len(w), 1)))} for w in texts]
    want = set(exact_groups(sets))
    few = {r.doc_id for r in simhash.deduplicated(docs_of(rows), radius=0, prints=1).collect()}
    assert len(few) > len(want) + 50
    for some in (3, 64):
        monkeypatch.setattr(simhash, "FEW", some)
        assert {r.doc_id for r in simhash.deduplicated(docs_of(rows), radius=0, prints=1, whole=True).collect()} == want


def test_pipeline_stage_misses_no_pair_of_little_over_the_least_similarity(spark, docs_of):
    rng = random.Random(15)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9)))
    texts = []
    while len(texts) < 700:
        base = [word() for _ in range(rng.randint(20, 60))]
        other = edited(rng, base, word, 3)
        a, b = ({tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in (base, other))
        if 0.8 <= len(a & b) / len(a | b) <= 0.85:
            texts += [base, other]
    docs = docs_of([(i, " ".join(w)) for i, w in enumerate(texts)])
    assert {r.doc_id for r in corpus_pipeline.dedup_stage(spark, docs, "").collect()} == set(range(0, 700, 2))


def test_rarest_shingles_of_similar_sets_meet():
    rng = np.random.default_rng(22)
    counts = rng.integers(0, 5, 1 << simhash.SLOT_BITS)
    met = 0
    for _ in range(3000):
        a = rng.choice(1 << 62, rng.integers(1, 60), replace=False).astype(np.uint64) << np.uint64(2)
        b = np.unique(np.concatenate([a[rng.integers(0, 9) :], rng.choice(1 << 62, rng.integers(0, 9)).astype(np.uint64)]))
        a = np.unique(a)
        if len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b)):
            met += 1
            assert len(np.intersect1d(simhash.rarest(a, counts, 0.8), simhash.rarest(b, counts, 0.8)))
    assert met > 300
