"""Sharding, mixing, token files, token attribution."""

import random
import re
import zlib

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from mixloom.llm import attribution, mixing, shards, token_files, tokens
from mixloom.llm.queries import tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def least_capacity(sizes, n):
    low, high = max([1, -(-sum(sizes) // n)]), max(1, sum(sizes))
    while low < high:
        middle, used, filled = (low + high) // 2, 1, 0
        for s in sizes:
            if s > middle:
                used = n + 1
            if filled + s > middle:
                used, filled = used + 1, 0
            filled += s
        low, high = (low, middle) if used <= n else (middle + 1, high)
    return low


@pytest.mark.parametrize("digits", [1, 2])
@pytest.mark.parametrize("seed", range(4))
def test_shards_are_as_small_as_can_be(frame, seed, digits):
    rng = random.Random(seed)
    texts = ["x" * rng.choice([0, 1, 5, 40, 300, 3000 * seed]) + str(rng.randrange(60)) for _ in range(200)] + [None, "", "é"]
    sized = frame("digest string, size long", *[(shards_digest(t), len((t or "").encode()) + 16) for t in texts])
    groups = {}
    for t in texts:
        groups[shards_digest(t)] = groups.get(shards_digest(t), 0) + len((t or "").encode()) + 16
    ordered = [groups[k] for k in sorted(groups)]
    for n in (1, 3, 7, 40):
        capacity, cuts = shards.find_cuts(sized, n, digits)
        assert capacity == least_capacity(ordered, n) and len(cuts) == n - 1 and cuts == sorted(cuts)
        filled = [0] * n
        for key, size in groups.items():
            filled[sum(key > c for c in cuts)] += size
        assert max(filled) <= capacity


def shards_digest(text):
    import hashlib

    return hashlib.sha256((text or "").encode()).hexdigest()


def test_sharding(frame):
    texts = [f"text {n % 50} " * (n % 7) for n in range(300)] + [None, "", "é"]
    df = frame("doc_id long, text string, shard string", *[(n, t, "x") for n, t in enumerate(texts)], (None, "a", "x"), (5, "a", "x"), (5, "a", "x"))
    found = shards.shard_documents(df, 6).collect()
    assert len(found) == df.count() and {r.law for r in found} == {"bytes"}
    slots, where = {}, {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
        where.setdefault(r.text_crc32, set()).add(r.shard)
        if r.doc_id is not None and r.doc_id != 5:
            data = (texts[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert all(len(s) == 1 for s in where.values())
    assert shards.shard_documents(df.limit(0), 6).count() == 0


def test_targets():
    assert mixing.targets([100, 100, 100]) == [200.0, pytest.approx(250 / 3), pytest.approx(500 / 3)]
    assert mixing.targets([10, 1000, 1000]) == [20.0, pytest.approx(2995 / 3), pytest.approx(5990 / 3)]
    assert mixing.targets([0, 0]) == [0.0, 0.0] and mixing.targets([]) == []
    assert mixing.targets([8]) == [12.0]


@pytest.mark.parametrize("n", [1, 2, 3, 64, 65, 1000])
def test_permutations(n):
    one, other = (mixing.permuted(np.arange(n), np.full(n, n), np.full(n, key)) for key in (1, 2))
    assert sorted(one) == sorted(other) == list(range(n)) and (n < 64 or (one != other).any())


def test_draws_use_all_slots():
    counts = mixing.draw_counts([100, 0, 7, 1000], 9)
    assert counts.sum(axis=0).tolist() == [100, 0, 7, 1000] and np.ptp(counts.sum(axis=1)) <= 1


def mixed_input(frame):
    rng = random.Random(2)
    rows = [(n, " ".join(f"d{n}w{k}" for k in range(rng.randrange(90))), rng.choice(["a", "a", "b", "B", "é", None])) for n in range(120)]
    rows += [(200, None, "a"), (201, "", "b"), (202, " \n", "c"), (None, "x y", "a"), (5, "again and", "a"), (5, "again and", "a")]
    return frame("doc_id long, text string, source string, size string, n_chars long", *[(*r, "s", len(r[1] or "")) for r in rows]), rows


def test_mixing(frame):
    df, rows = mixed_input(frame)
    first, again = ([tuple(r) for r in mixing.mixed_words(df.repartition(n), block=16).collect()] for n in (1, 5))
    assert sorted(first, key=str) == sorted(again, key=str) and len(first) == len(rows)
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(WORD.findall(t or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    target = dict(zip(order, mixing.targets([size[s] for s in order])))
    of = {(size[s], target[s]) for s in order}
    assert {(r[2], r[3]) for r in first} == of and all(r[4] <= 2 * r[1] for r in first)
    for source_size, wanted in of:
        same = [s for s in order if (size[s], target[s]) == (source_size, wanted)]
        assert sum(r[4] for r in first if (r[2], r[3]) == (source_size, wanted)) == len(same) * round(wanted)
    assert mixing.mixed_words(df.limit(0)).count() == 0


def test_mixed_documents_have_the_words_taken(frame):
    df, rows = mixed_input(frame)
    unique = df.where("doc_id is not null and doc_id <> 5")
    taken = {r.doc_id: r.taken for r in mixing.mixed_words(unique, block=16).collect()}
    words = {i: WORD.findall(t or "") for i, t, _ in rows}
    found = {}
    for r in mixing.mixed_documents(unique, block=16).collect():
        own = WORD.findall(r.text)
        assert set(own) <= set(words[r.doc_id]) and r.n_chars == len(r.text)
        found[r.doc_id] = found.get(r.doc_id, 0) + len(own)
    assert found == {i: n for i, n in taken.items() if n}
    assert mixing.mixed_documents(df.limit(0)).columns == df.columns
    held = {}
    for r in mixing.mix(unique, block=16).collect():
        held[r.doc_id] = held.get(r.doc_id, 0) + r.n
    assert held == found


ODD = ["<|endoftext|>", "x <|endoftext|> y", "", "日本 é Σς ΑΣ", "a\u00a0b", "\x1c a", "it's I'LL we'Re", "  a   b \n\n c  ", "e\u0301 ½²"]


def odd_texts():
    rng = random.Random(1)
    letters = "aAbB zZ\n\t '.,!?0123½²×÷éÉßªµº-_sSdDtT\r\xadreRE"
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(500)]


@pytest.mark.parametrize("name, kind", [("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "bytes")])
def test_remembered_pieces_give_the_tokenizers_ids_and_places(name, kind, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 300)
    encoder = tokens.Encoder(tokenizer(name), kind)
    whole = Tokenizer.from_file(public_tokenizers.path(name))
    sizes = tokens.token_bytes(whole)
    texts = odd_texts()
    for at in range(0, len(texts), 60):
        for text, ids in zip(texts[at : at + 60], encoder.encode(texts[at : at + 60])):
            expected = whole.encode(text, add_special_tokens=False)
            assert ids.tolist() == expected.ids
            if kind == "bytes" and text and encoder.plain(text):
                assert list(zip(*(x.tolist() for x in tokens.spans(text, ids, sizes)))) == expected.offsets


def test_blocks():
    for n in (0, 1, 9, 65_536):
        ids = np.random.default_rng(n).integers(0, 2 ** (n % 31 + 1), n).astype(np.uint32)
        assert (token_files.unpack(token_files.pack(ids)) == ids).all()
    with pytest.raises(ValueError):
        token_files.unpack(b"XXXX\x01")


def test_token_files(spark, frame, tmp_path):
    rng = random.Random(4)
    texts = {n: " ".join(rng.choice(["the", "of", "Étude", "zq"]) for _ in range(rng.choice([0, 3, 30, 400]))) for n in rng.sample(range(9999), 90)}
    df = frame("doc_id long, text string, start long", *[(n, t, 1) for n, t in texts.items()], (None, "none", 1), (10_000, None, 1), (10_001, "b", 1), (10_001, "a", 1))
    token_files.write(df, str(tmp_path / "t"), tokenizer("word_bpe_49k.json"), block=64)
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    at, expected, stream = 0, [], []
    for doc_id, text in [(None, "none"), *sorted(texts.items()), (10_000, ""), (10_001, "a"), (10_001, "b")]:
        ids = [*whole.encode(text, add_special_tokens=False).ids, 2]
        expected.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at, stream = at + len(ids), stream + ids
    found = [tuple(r) for r in token_files.read_documents(spark, str(tmp_path / "t")).collect()]
    assert sorted(found, key=lambda r: r[1]) == expected
    blocks = sorted(token_files.read_blocks(spark, str(tmp_path / "t")).collect(), key=lambda b: b.first_id)
    assert np.concatenate([token_files.unpack(b.payload) for b in blocks]).tolist() == stream
    token_files.write(df.limit(0), str(tmp_path / "e"), tokenizer("word_bpe_49k.json"))
    assert token_files.read_documents(spark, str(tmp_path / "e")).count() == 0


def brute_sections(fields, rule):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    document, names, bounds = "\n".join(fields), [], []
    at = 0
    for f, text in enumerate(fields):
        for k, line in enumerate(re.findall(r"[^\n]*\n|[^\n]+$", text) or [""]):
            names.append((f, k))
            bounds.append(at)
            at += len(line)
        at += 1
    counts = [0.0] * len(names)
    ends = [*bounds[1:], len(document)]
    for a, b in whole.encode(document, add_special_tokens=False).offsets:
        part = [max(0, min(b, e) - max(a, s)) for s, e in zip(bounds, ends)]
        if rule == "share":
            counts = [c + p / sum(part) for c, p in zip(counts, part)]
        else:
            counts[part.index(max(part)) if rule == "most" else next(n for n, p in enumerate(part) if p)] += 1
    return {name: round(c, 9) for name, c in zip(names, counts)}


@pytest.mark.parametrize("rule", ["most", "first", "share"])
def test_attribution(frame, rule):
    texts = ["one two\n\n\nthree\n", None, "", "\n", "日本\n語 é\né", "a" * 3000 + "\n\n" + "b", "x <|endoftext|>\ny"]
    df = frame("doc_id long, title string, text string, section string", *[(n, "Title\nhere", t, "s") for n, t in enumerate(texts)])
    found = {}
    for r in attribution.attribute(df, tokenizer("byte_bpe_50k.json"), ["title", "text"], rule=rule).collect():
        found.setdefault(r.doc_id, {})[(["title", "text"].index(r.field), r.section)] = round(r.n_tokens, 9)
    assert found == {n: brute_sections(["Title\nhere", t or ""], rule) for n, t in enumerate(texts)}
    assert attribution.attribute(df.limit(0), tokenizer("byte_bpe_50k.json"), ["text"]).count() == 0
