"""Packing: the plan against best-two-fit one sequence at a time, the packed ids against the tokenizer's."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations_with_replacement
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from mixloom.llm import packing


def definition():
    return Path(public_tokenizers.path("byte_bpe_50k.json")).read_text()


def brute_plan(lengths, capacity):
    """Sequences, each a sorted list of lengths, made one at a time."""
    left, out = sorted(lengths, reverse=True), []
    while left:
        own, gap = [], capacity
        for n in list(left):
            if n <= gap:
                own.append(n)
                left.remove(n)
                gap -= n
        smallest = own[-1]
        free = Counter(left) + Counter([smallest])
        pairs = [
            (a + b, a, b)
            for b, a in combinations_with_replacement(sorted(free), 2)
            if a + b <= gap + smallest and a + b > smallest and (a != b or free[a] > 1)
        ]
        if pairs:
            _, a, b = max(pairs)
            own.remove(smallest)
            left = sorted((free - Counter([a, b])).elements(), reverse=True)
            own += [a, b]
        out.append(sorted(own))
    return out


def planned(counts, capacity):
    """The sequences of a plan, with every rank used once and no gap between places."""
    held, ranks = defaultdict(list), defaultdict(list)
    for length, start, to, copies, place, first in packing.plan(counts, capacity):
        for rank in range(start, to):
            ranks[length].append(rank)
            step = rank - start
            held[first + step // copies].append((place + step % copies * length, length))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items() if c}
    for own in held.values():
        at = 0
        for place, length in sorted(own):
            assert place == at
            at += length
        assert at <= capacity
    return [sorted(n for _, n in own) for own in held.values()]


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_best_two_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 2, 7, 20, 61])
    pool = [rng.randint(1, capacity) for _ in range(rng.choice([1, 3, 12]))]
    lengths = [rng.choice(pool) for _ in range(rng.choice([0, 1, 9, 80]))]
    assert Counter(map(tuple, planned(Counter(lengths), capacity))) == Counter(map(tuple, brute_plan(lengths, capacity)))


def test_two_smaller_ones_replace_the_smallest():
    assert sorted(planned({6: 1, 3: 1, 2: 2}, 10)) == [[2, 2, 6], [3]]


def test_plan_does_not_grow_with_the_number_of_pieces():
    rng = random.Random(3)
    counts = {n: rng.randint(1, 50) for n in range(1, 129)}
    few = len(packing.plan(counts, 128))
    many = packing.plan({n: c * 10**9 for n, c in counts.items()}, 128)
    assert len(many) < 4 * few
    filled = sum(n * c * 10**9 for n, c in counts.items()) / 128
    assert max(first + (to - start) // copies for _, start, to, copies, _, first in many) <= filled * 1.02


def test_lengths_out_of_range():
    with pytest.raises(ValueError):
        packing.plan({9: 1}, 8)


def texts():
    rng = random.Random(5)
    words = ["alpha", "beta,", "gamma\n", "Ünder", "日本", "  x", "0123456789"]
    made = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 30, 200]))) for _ in range(120)]
    return [*made, None, "", "<|endoftext|>", "long " * 5000, "z" * 3000, *["copy of a text"] * 60]


@pytest.mark.parametrize("capacity", [16, 300])
def test_packed_pieces_hold_the_tokenizers_ids(spark, frame, capacity):
    rows = [(n, t, "s", 1, 2) for n, t in enumerate(texts())] + [(7, "again", "s", 1, 2)] * 3 + [(None, "no id", "s", 1, 2)] * 2
    df = frame("doc_id long, text string, ids string, rank int, length int", *rows).repartition(5)
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter()
    for doc_id, text, *_ in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        n = -(-len(ids) // capacity)
        first = len(ids) - (n - 1) * capacity
        bounds = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
            expected[(doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    sequences = packing.sequences(packing.pack(df, definition(), capacity), packing.id_width(definition()), most=7)
    built = sequences.collect()
    got = packing.digest_pieces(sequences).collect()
    assert Counter(tuple(r)[:5] for r in got) == expected
    assert len({r.sequence_id for r in built}) == len(built)
    for r in built:
        at = 0
        for p in r.pieces:
            assert p.offset == at
            at += p.length
        assert at <= capacity and len(r.ids) == 2 * at
    lengths = [key[3] for key, n in expected.items() for _ in range(n)]
    assert Counter(tuple(sorted(p.length for p in r.pieces)) for r in built) == Counter(map(tuple, brute_plan(lengths, capacity)))


def test_nothing_to_pack(frame):
    empty = frame("doc_id long, text string")
    assert packing.digest_pieces(packing.sequences(packing.pack(empty, definition()), 2)).collect() == []


def test_one_length_in_many_parts(spark):
    """A third of the rows alike: ranks of a length are dealt over all parts and no join or window gathers them."""
    df = spark.range(0, 3000, 1, 12).selectExpr("id AS doc_id", "if(id % 3 = 0, 'same text', concat('text ', id)) AS text")
    made = packing.pieces(df, definition())
    sizes = made.groupBy("part").count().collect()
    assert len(sizes) == 12 and max(r["count"] for r in sizes) < 400
    packed = packing.pack(df, definition(), 64).collect()
    assert len({(r.sequence_id, r.offset) for r in packed}) == 3000
