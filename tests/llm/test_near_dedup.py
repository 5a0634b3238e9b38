import random
from collections import Counter, defaultdict

import numpy as np
from conftest_words import words_of

from lodestone.llm import near_dedup
from lodestone.llm.components import components
from lodestone.llm.near_dedup import dart_minhash, near_duplicates, shingles
from lodestone.llm.queries import op6_minhash_near_dedup


def brute(rows, size=5, threshold=0.8):
    ids = [i for i, _ in rows if i is not None]
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(a, b):
        a, b = sorted((root(a), root(b)))
        parent[b] = a

    sets, whole, inverted = [], defaultdict(list), defaultdict(list)
    for k, (i, text) in enumerate(rows):
        words = tuple(words_of(text))
        times = Counter(words[j : j + size] for j in range(len(words) - size + 1)) or ({words: 1} if words else {})
        own = {(s, n) for s, most in times.items() for n in range(most)}
        sets.append(own)
        if i is not None:
            whole[words].append(i)
            for s in own:
                inverted[s].append(k)
    for same in whole.values():
        for other in same[1:]:
            join(same[0], other)
    both = defaultdict(int)
    for found in inverted.values():
        for x in range(len(found)):
            for y in range(x):
                both[found[y], found[x]] += 1
    for (a, b), n in both.items():
        if n >= threshold * (len(sets[a]) + len(sets[b]) - n):
            join(rows[a][0], rows[b][0])
    return sorted(((i, root(i) if i is not None else None) for i, _ in rows), key=repr)


def check(found, rows):
    got = found.collect()
    assert sorted(((r.doc_id, r.class_id) for r in got), key=repr) == brute(rows)
    assert all(r.kept == (r.doc_id == r.class_id or r.doc_id is None) for r in got)


def test_messy(messy):
    check(near_duplicates(messy[1]), messy[0])


def test_documents(spark, sf_dir, documents):
    check(op6_minhash_near_dedup(spark, sf_dir), [(d["doc_id"], d["text"]) for d in documents])


def test_a_group_of_near_copies_and_texts_with_a_common_passage(spark):
    rng = random.Random(2)
    word = lambda: f"w{rng.randrange(10**6)}"
    base, passage = [word() for _ in range(300)], [word() for _ in range(100)]
    rows = []
    for k in range(120):
        copy = list(base)
        for _ in range(rng.randint(0, 8)):
            copy[rng.randrange(300)] = word()
        rows.append((k, " ".join(copy)))
    rows += [(1000 + k, " ".join(passage + [word() for _ in range(60)])) for k in range(60)]
    check(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)), rows)


def sparse_links(family, links, shared=124, own=17):
    """Texts of one template, about 0.78 alike, of which a few pairs share 2 to 4 of their own words as well: 0.80 to 0.83."""
    rng = random.Random(family)
    word = lambda: f"w{rng.randrange(10**9)}"
    template = [word() for _ in range(shared)]
    texts = [template + [word() for _ in range(own)] for _ in range(family)]
    for a, b in (rng.sample(range(family), 2) for _ in range(links)):
        n = shared + rng.randint(2, 4)
        texts[b][:n] = texts[a][:n]
    return [(k, " ".join(t)) for k, t in enumerate(texts)]


def dense_brute(rows, size=5, threshold=0.8):
    number = defaultdict(lambda: len(number))
    sets = [np.unique([number[tuple(t[j : j + size])] for j in range(len(t) - size + 1)]) for t in (text.split() for _, text in rows)]
    seen = np.bincount(np.concatenate(sets))
    place = np.cumsum(seen > 1) - 1
    has = np.zeros((len(rows), int((seen > 1).sum())), np.float32)
    for k, s in enumerate(sets):
        has[k, place[s[seen[s] > 1]]] = 1
    sizes, both = np.array([len(s) for s in sets]), has @ has.T
    found = list(range(len(rows)))
    for _ in rows:
        before = list(found)
        for a, b in np.argwhere(np.triu(both >= threshold * (sizes[:, None] + sizes - both) - 1e-6, 1)):
            found[a] = found[b] = min(found[a], found[b])
        if found == before:
            return {rows[k][0]: rows[c][0] for k, c in enumerate(found)}


def test_sparse_links_in_a_family_larger_than_blocks(spark):
    rows = sparse_links(2400, 300)
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    wanted = dense_brute(rows)
    assert sum(k != c for k, c in wanted.items()) > 200
    assert {r.doc_id: r.class_id for r in found} == wanted


def test_sparse_links_within_a_block(spark):
    rows = sparse_links(250, 40)
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert {r.doc_id: r.class_id for r in found} == dense_brute(rows)


def test_bands_dont_give_the_links_of_a_family_anew(spark, monkeypatch):
    rng = random.Random(2)
    base, rows = [f"w{k}" for k in range(600)], []
    for k in range(600):
        copy = list(base)
        copy[rng.randrange(600)] = f"o{rng.randrange(10**6)}"
        rows.append((k, " ".join(copy)))
    made, plain = spark.sparkContext.accumulator(0), near_dedup._pairs

    def counted(*limits):
        run = plain(*limits)

        def tally(batches):
            for batch in run(batches):
                made.add(batch.num_rows)
                yield batch

        return tally

    monkeypatch.setattr(near_dedup, "_pairs", counted)
    # Many tasks, as in a cluster: one task alone remembers the pairs it has given.
    conf = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.doc_id: r.class_id for r in found} == dense_brute(rows)
    assert 0 < made.value < 10 * len(rows), made.value


def test_pairs_of_a_class_are_not_given():
    rng = np.random.default_rng(3)
    sketches = np.where(rng.random((40, 240)) < 0.1, rng.integers(0, 1 << 16, (40, 240)), 7).astype("<u2")
    classes = np.arange(40) // 10
    found, _ = near_dedup.block_pairs(sketches, classes, 0.6, 0.99)
    assert {(classes[i], classes[j]) for i, j, _ in found} and all(classes[i] != classes[j] for i, j, _ in found)
    alone, _ = near_dedup.block_pairs(sketches, np.arange(40), 0.6, 0.99)
    assert len(alone) >= 39 > len(found) >= 3


def test_empty(nothing):
    assert near_duplicates(nothing).count() == 0


def test_signatures_estimate_the_weighted_similarity():
    rng = np.random.default_rng(1)
    k = 400
    for shared, other in ((50, 10), (30, 70), (500, 60)):
        names = rng.integers(1, 2**63, shared + 2 * other).astype(np.uint64)
        weights = rng.integers(1, 5, len(names)).astype(float)
        a, b = np.r_[0:shared, shared : shared + other], np.r_[0:shared, shared + other : shared + 2 * other]
        wb = weights.copy()
        wb[: shared // 2] += 1
        signed = dart_minhash(np.r_[names[a], names[b]], np.r_[weights[a], wb[b]], np.repeat([0, 1], [len(a), len(b)]), 2, k)
        low = np.minimum(weights[:shared], wb[:shared]).sum()
        high = np.maximum(weights[:shared], wb[:shared]).sum() + weights[a[shared:]].sum() + wb[b[shared:]].sum()
        found = (signed[0] == signed[1]).mean()
        assert abs(found - low / high) < 5 * np.sqrt(0.25 / k)


def test_signatures_dont_depend_on_the_batch():
    rng = np.random.default_rng(4)
    x, y = rng.integers(1, 2**63, 40).astype(np.uint64), rng.integers(1, 2**63, 3).astype(np.uint64)
    alone = dart_minhash(x, np.ones(40), np.zeros(40, int), 1, 64)
    both = dart_minhash(np.r_[y, x], np.ones(43), np.repeat([0, 1], [3, 40]), 3, 64)
    assert (both[1] == alone[0]).all() and (both[2] == 0).all() and (both[0] != 0).all()


def test_short_texts_have_one_shingle():
    assert [len(x) for x in shingles(np.arange(3, dtype=np.uint64))] == [1, 1] and len(shingles(np.zeros(0, np.uint64))[0]) == 0


def test_shingles_weigh_as_much_as_they_occur(spark):
    line, rest = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(40))
    rows = [(1, f"{line} {rest}"), (2, f"{' '.join([line] * 8)} {rest}"), (3, f"{' '.join([line] * 9)} {rest}")]
    check(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), rows)
    assert {i: c for i, c in brute(rows)} == {1: 1, 2: 2, 3: 2}


def test_rows_of_one_id_are_compared_each(spark):
    body, other = " ".join(f"a{k}" for k in range(90)), " ".join(f"b{k}" for k in range(90))
    rows = [(1, body), (2, body + " tail"), (2, other), (3, other + " tail"), (4, other), (4, other), (1, "short"), (1, body + " end")]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.class_id) for r in found) == [(1, 1), (1, 1), (1, 1), (2, 1), (2, 2), (3, 2), (4, 2), (4, 2)]
    assert sum(r.kept for r in found) == 3 and {(r.doc_id, r.class_id) for r in found if r.kept} == {(1, 1), (2, 2)}


def test_components_of_chains_and_stars(spark):
    rng = random.Random(9)
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(260, 7), (3, 3), (5, 2)]
    rng.shuffle(edges)
    found = {r.u: r.v for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {k: 100 for k in range(101, 161)} | {k: 7 for k in range(200, 261)} | {5: 2}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
