"""Token counts and packing against the tokenizers themselves."""

import os
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tideglass.llm import arrowtext, chunks, packing, token_counts
from tideglass.llm.arrowtext import steps

BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [
    "a", "b c", " ", "  ", "\n", "\t", "'s", "'ll", "don't", "é", "è ", "中文", "　", "▁", "▁ x",
    "<|endoftext|>", "x<|endoftext|>y", "</s>", "<s> ", "|>", "|", "!", ",", "123", " 42.", "\U0001f600",
    " \n ", "\r\n", "ß ", "_", "A.B", "\x00", "\x1f ", "\u0085", "é ",
]


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)
    made = ["".join(draw.choices(PARTS, k=draw.randint(1, 25))) for _ in range(3000)]
    return ["", None, " ", "  a", "a ", *made]


def byte_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BYTE_LEVEL)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_lengths_are_those_of_the_library(texts):
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    column = pa.array(texts)
    assert token_counts._count_pieces(column, PIECES).tolist() == [
        len(processor.encode(t or "")) for t in texts
    ]
    assert token_counts._count_bytes(column, BYTE_LEVEL).tolist() == [len(i) for i in byte_ids(texts)]


def test_ids_are_those_of_the_library(texts):
    ids, lengths = packing.encode_rows(pa.array(texts), BYTE_LEVEL, 2)
    expected = [i + [2] for i in byte_ids(texts)]
    assert lengths.tolist() == [len(e) for e in expected]
    assert ids.tolist() == [i for e in expected for i in e]


def test_steps_cover_all_rows_by_bytes():
    batch = pa.RecordBatch.from_pydict({"text": ["ab", None, "c" * 50, "", "d" * 9]})
    parts = list(steps([batch], limit=10))
    assert [v for p in parts for v in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert len(parts) > 1


def test_counts_of_odd_rows(odd, none):
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = token_counts.token_counts(odd, PIECES, limit=50).collect()
    expected = Counter()
    for row in odd.collect():
        text = row["text"] or ""
        n = len(processor.encode(text))
        expected[(row["doc_id"], len(text.encode()), n, n > 50)] += 1
    assert Counter(map(tuple, found)) == expected
    assert token_counts.token_counts(none, PIECES).collect() == []


def test_packing_odd_rows_round_trip(odd, none):
    rows = packing.pack(packing.pieces(odd, BYTE_LEVEL, 64, 2), 64).collect()
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    expected = Counter()
    for (doc_id, _), ids in zip(texts, byte_ids([t for _, t in texts])):
        ids = np.array(ids + [2], dtype="<u4")
        head = (len(ids) - 1) % 64 + 1
        cuts = [0, *range(head, len(ids) + 1, 64)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[(doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert Counter(tuple(r)[:5] for r in rows) == expected
    bins = {}
    for row in rows:
        bins.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(packing.pieces(none, BYTE_LEVEL, 64, 2), 64).collect() == []


def simple(lengths, capacity):
    """Best-two-fit piece by piece, without multiplicities."""
    left, bins = sorted(lengths), []
    while left:
        bin_, gap = [], capacity
        while fits := [x for x in left if x <= gap]:
            bin_.append(fits[-1])
            left.remove(fits[-1])
            gap -= fits[-1]
        if gap:
            small = min(bin_)
            pairs = [
                (a + b, a, b)
                for i, a in enumerate(left)
                for b in left[i + 1 :]
                if small < a + b <= gap + small
            ]
            if pairs:
                _, a, b = max(pairs)
                bin_.remove(small)
                bin_ += [a, b]
                left.remove(a)
                left.remove(b)
                left = sorted([*left, small])
        bins.append(sorted(bin_))
    return bins


@pytest.mark.parametrize("seed", range(6))
def test_plan_equals_packing_one_by_one(seed):
    draw = random.Random(seed)
    lengths = [draw.randint(1, 30) for _ in range(draw.randint(1, 200))]
    plan = packing.plan(Counter(lengths), 30)
    bins = [[] for _ in range(plan.bins)]
    order = np.lexsort((plan.number, plan.length))
    assert (order == np.arange(len(order))).all()
    number, seen = Counter(lengths), Counter()
    for i in range(len(plan.length)):
        length = plan.length[i]
        last = i + 1 == len(plan.length) or plan.length[i + 1] != length
        end = number[length] if last else plan.number[i + 1]
        for k in range(end - plan.number[i]):
            bins[plan.bin[i] + k].append((int(plan.offset[i]), int(length)))
            seen[length] += 1
    assert seen == number
    assert [sorted(length for _, length in b) for b in bins] == simple(lengths, 30)


def test_a_swap_saves_a_bin():
    # Greedy fills 6 + 3 of 10; the two 2s fit the gap of the 3 better.
    plan = packing.plan({6: 1, 3: 1, 2: 2}, 10)
    assert plan.bins == 2
    assert sorted(plan.length[plan.bin == 0].tolist()) == [2, 2, 6]


def test_a_worker_lets_go_of_another_operators_cache():
    batch = pa.RecordBatch.from_arrays([pa.array(["some text", None])], names=["text"])
    packing.encode_rows(batch.column("text"), BYTE_LEVEL, 2)
    assert len(list(arrowtext.steps([batch], keeps=packing.byte_ids))) == 1
    assert packing.byte_ids.cache_info().currsize
    list(arrowtext.steps([batch]))
    assert not packing.byte_ids.cache_info().currsize


def _counted(cache):
    encoded, plain = [], cache.encode
    cache.encode = lambda texts: encoded.extend(texts) or plain(texts)
    return encoded


def test_a_cache_of_ids_holds_many_chunks_in_few_bytes():
    cache = packing.byte_ids.__wrapped__(BYTE_LEVEL)
    cache.most = 1 << 20
    encoded = _counted(cache)
    column = pa.array([" ".join(f"w{i}" for i in range(18_000))])
    for _ in range(2):
        cache.values(*chunks.chunk_spans(column, chunks.BYTE_LEVEL)[:3])
    assert len(encoded) == 18_000


def test_a_full_cache_gives_the_same_ids(texts):
    cache = packing.byte_ids.__wrapped__(BYTE_LEVEL)
    cache.most = 1500
    for low in range(0, len(texts), 7):
        some = texts[low : low + 7]
        data, start, end, first = chunks.chunk_spans(pa.array(some, pa.string()), chunks.BYTE_LEVEL)
        ids, sizes, place = cache.values(data, start, end)
        begin = np.cumsum(sizes) - sizes
        found = [[i for p in place[a:b] for i in ids[begin[p] : begin[p] + sizes[p]]] for a, b in zip(first, first[1:])]
        assert found == byte_ids(some)
        assert cache.young.nbytes <= 1500 and cache.old.nbytes <= 3000


def test_chunks_are_encoded_in_bounded_lists_on_one_thread():
    column = pa.array([" ".join(f"w{i}" for i in range(3 * chunks.ENCODED_AT_ONCE))])
    cache, sizes = packing.byte_ids(BYTE_LEVEL), []
    plain = cache.encode

    def encode(texts):
        sizes.append(len(texts))
        return plain(texts)

    data, start, end, _ = chunks.chunk_spans(column, chunks.BYTE_LEVEL)
    values, place = chunks.ChunkCache(encode).values(data, start, end)
    assert len(sizes) > 2 and max(sizes) <= chunks.ENCODED_AT_ONCE
    whole = plain([bytes(data[a:b]).decode() for a, b in zip(start, end)])
    assert [values[i] for i in place] == whole
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
