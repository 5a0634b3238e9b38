import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lodestone.llm.packing import assemble, best_fit, best_fit_packing, bin_completion, cut_pieces, fillings, lower_bound
from lodestone.llm.queries import op3_best_fit_packing


def expected(rows, capacity=4096):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for k, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            out.append((i, k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out, key=repr)


def check(found, rows, capacity=4096):
    got = found.collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == expected(rows, capacity)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by), -(-sum(r.length for r in got) // capacity)


def test_messy(messy):
    check(best_fit_packing(messy[1]), messy[0])


def test_small_capacity_and_specials(spark):
    rows = [(1, "<|endoftext|> a<|startoftext|>b ÀÉ é x y z q"), (2, None), (3, "Hello, World's end! 12345 İstanbul ΑΣ"), (3, "hello " * 50)]
    check(best_fit_packing(spark.createDataFrame(rows, "doc_id long, text string"), capacity=16), rows, 16)


def test_documents_are_packed_as_tightly_as_can_be(spark, sf_dir, documents):
    used, least = check(op3_best_fit_packing(spark, sf_dir), [(d["doc_id"], d["text"]) for d in documents])
    assert used <= least + 1


def test_words_with_special_tokens_and_forgotten_words(spark, monkeypatch):
    from lodestone.llm import packing

    monkeypatch.setattr(packing, "CACHED_WORDS", 20)
    monkeypatch.setattr(packing, "_WORDS", {})
    rows = [(k, " ".join(f"x{j} <|endoftext|>{j}<|startoftext|> \x1c{j}\u00a0y" for j in range(k, k + 15)) + "\n") for k in range(40)]
    batch = pa.RecordBatch.from_pydict({"doc_id": [k for k, _ in rows], "text": [t for _, t in rows]})
    out = [r for part in cut_pieces(4096, 1, None, False)(iter([batch, batch])) for r in part.to_pylist()]
    assert sorted((tuple(r.values()) for r in out[: len(out) // 2]), key=repr) == expected(rows) and out[: len(out) // 2] == out[len(out) // 2 :]


def test_plain_words_take_the_light_path():
    from lodestone.llm.packing import PLAIN, WordIds

    letters = [chr(c) for c in range(0x180) if re.match(PLAIN, chr(c))]
    rng = random.Random(3)
    words = [*letters, *("".join(rng.choices(letters, k=rng.randint(2, 12))) + rng.choice(["", ".", "!?", "-", "%%%", "<|>", "'", "'s", "1", "é\u0301", "H\u0331", "\u0130", "\u0149", "\u017f", "ς"]) for _ in range(4000))]
    tokenizer, ids = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), WordIds(public_tokenizers.path("word_bpe_49k.json"))
    assert ids.light is not None and len(letters) > 150
    found = [np.frombuffer(x, "<u4").tolist() for x in ids.encode(pa.array(words))]
    assert found == [x.ids for x in tokenizer.encode_batch(words, add_special_tokens=False)]


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e")], "doc_id long, text string")
    packed = best_fit_packing(docs, with_ids=True)
    whole = assemble(packed).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: tokenizer.encode(t, add_special_tokens=False).ids + [1] for i, t in ((1, "a b c"), (2, "d e"))}
    assert len(whole) == 1 and np.frombuffer(bytes(whole[0].ids), "<u4").tolist() == [x for i in whole[0].doc_ids for x in ids[i]]


def test_empty(nothing):
    assert best_fit_packing(nothing).count() == 0


def optimum(lengths, capacity):
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(lengths):
            best = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + lengths[k] <= capacity and bins[j] not in bins[:j]:
                place(k + 1, [*bins[:j], bins[j] + lengths[k], *bins[j + 1 :]])
        place(k + 1, [*bins, lengths[k]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(40))
def test_search_is_valid_and_optimal_on_small_cases(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 20, 30])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 10))]
    counts = {x: lengths.count(x) for x in set(lengths)}
    plan = bin_completion(counts, capacity)
    packed = [x for p, n in plan for x in p * n]
    assert sorted(packed) == sorted(lengths) and all(sum(p) <= capacity for p, _ in plan)
    size = sum(n for _, n in plan)
    assert lower_bound(counts, capacity) <= optimum(lengths, capacity) == size <= sum(n for _, n in best_fit(counts, capacity))


def test_search_betters_best_fit_where_that_misses():
    missed = 0
    for seed in range(1500):
        rng = random.Random(seed)
        capacity = rng.choice([10, 20, 30, 50])
        lengths = [rng.randint(2, capacity * 2 // 3) for _ in range(rng.randint(1, 12))]
        counts = {x: lengths.count(x) for x in set(lengths)}
        least = optimum(lengths, capacity)
        missed += sum(n for _, n in best_fit(counts, capacity)) > least
        assert sum(n for _, n in bin_completion(counts, capacity)) == least
    assert missed > 20


def test_fillings_of_a_full_enumeration_are_the_undominated_ones():
    lengths, counts = [7, 5, 4, 3, 2], [1, 1, 1, 2, 1]
    found = fillings(lengths, {x: k for k, x in enumerate(lengths)}, counts, 0, 14, lambda: True)
    assert [[lengths[k] for k in f] for f in found] == [[7, 5, 2], [7, 4, 3]]


def test_huge_counts_take_few_steps():
    rng = random.Random(1)
    counts = {x: rng.randint(1, 10**9) for x in range(1, 4097)}
    plan = bin_completion(counts, 4096)
    assert len(plan) < 50_000 and sum(sum(p) * n for p, n in plan) == sum(x * n for x, n in counts.items())
