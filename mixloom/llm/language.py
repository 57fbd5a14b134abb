"""Language identification with bit-sliced Bloom filters over n-grams.

Four-byte n-grams of lower-cased words, with their ends, are counted per language in a bounded sample of labelled rows.
An n-gram belongs to each language in which its rate is at least ``RATIO`` of its greatest rate. One Bloom filter per
language is stored bit-sliced: a position holds a bit for each language, so reading the positions of an n-gram and
combining them by AND returns all its languages at once. The bits of a text's n-grams are counted per language, the
number expected from false positives is taken off, and the greatest count decides; equal counts go to the first
language by name.

The sample is of about ``SAMPLE`` rows per language, chosen by the hash of the id; all else covers all rows. A null text,
or one without letters, is ``und`` with score 0. A text none of whose n-grams is known gets the commonest learned language
with score 0. Score: the language's part of all corrected counts. If nothing can be learned all is ``und``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mixloom.llm.base import in_slices, unused
from mixloom.llm.words import INSIDE, mixed

SAMPLE = 2000
RATIO = 0.2
LEAST = 2
BITS = 21
HASHES = 3
STRETCH = 1 << 18
# Includes numbers such as fractions, which are no letters.
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    return any(m[0].isalpha() for m in LETTER.finditer(text or ""))


def _grams(data: bytes) -> np.ndarray:
    """The n-grams of bytes, of which those of no word are blanks."""
    b = np.frombuffer(data, np.uint8)
    b = np.where(INSIDE[b], b, np.uint8(32)).astype(np.uint32)
    return b[:-3] | (b[1:-2] << np.uint32(8)) | (b[2:-1] << np.uint32(16)) | (b[3:] << np.uint32(24))


BLANK = 0x20202020


def _padded(text: str) -> bytes:
    return b"   " + text.lower().encode("utf-8", "surrogatepass") + b"   "


def _positions(grams: np.ndarray, bits: int, hashes: int) -> list[np.ndarray]:
    h = mixed(grams.astype(np.uint64) + np.uint64(1))
    low = np.uint64((1 << bits) - 1)
    step = (h >> np.uint64(40)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return [((h + step * np.uint64(k)) & low).astype(np.int64) for k in range(hashes)]


@dataclass(frozen=True)
class Model:
    """``table``: for each position, as many languages in a word as it has bits. ``commonest``: for texts of which
    nothing is known."""

    languages: list[str]
    table: np.ndarray
    commonest: str
    hashes: int = HASHES

    @property
    def bits(self) -> int:
        return len(self.table).bit_length() - 1

    @cached_property
    def false_rates(self) -> np.ndarray:
        rates = [self.holds(self.table, n).mean() ** self.hashes for n in range(len(self.languages))]
        return np.array(rates)

    @staticmethod
    def holds(masks: np.ndarray, n: int) -> np.ndarray:
        """The bit of language ``n`` in each row."""
        wide = 8 * masks.itemsize
        return (masks[:, n // wide] >> masks.dtype.type(n % wide)) & masks.dtype.type(1)


def _parts(texts: list[str]) -> Iterator[tuple[list[int], bytes]]:
    """Batches of texts as one stretch of bytes; very long texts come in several stretches of their own."""
    owners, parts, size = [], [], 0
    for n, text in enumerate(texts):
        data = _padded(text)
        for at in range(0, max(1, len(data) - 3), STRETCH):
            part = data[at : at + STRETCH + 3]
            owners.append(n)
            parts.append(part)
            size += len(part)
            if size >= STRETCH:
                yield owners, parts
                owners, parts, size = [], [], 0
    if parts:
        yield owners, parts


def counts(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """How many n-grams each text has, and how many of them each language may have."""
    n_grams = np.zeros(len(texts), np.int64)
    found = np.zeros((len(texts), len(model.languages)), np.int64)
    for owners, parts in _parts(texts):
        grams = _grams(b"".join(parts))
        # The n-grams that reach over the end of a part are no text's.
        lengths = np.array([len(p) for p in parts])
        starts = np.cumsum(lengths) - lengths
        inner = np.ones(len(grams), bool)
        for back in range(1, 4):
            over = starts[1:] - back
            inner[over[over >= 0]] = False
        inner &= grams != BLANK
        owner = np.repeat(np.arange(len(parts)), lengths)[: len(grams)][inner]
        grams = grams[inner]
        if not len(grams):
            continue
        masks = None
        for at in _positions(grams, model.bits, model.hashes):
            masks = model.table[at] if masks is None else masks & model.table[at]
        own = np.array(owners)
        np.add.at(n_grams, own, np.bincount(owner, minlength=len(parts)))
        for n in range(len(model.languages)):
            held = model.holds(masks, n) > 0
            np.add.at(found[:, n], own, np.bincount(owner[held], minlength=len(parts)))
    return n_grams, found


def decide(texts: list[str | None], model: Model) -> tuple[list[str], list[float]]:
    if not model.languages:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    known = [t if has_letter(t) else "" for t in texts]
    n_grams, found = counts(known, model)
    false = model.false_rates
    corrected = np.maximum(0, (found - n_grams[:, None] * false) / (1 - false))
    best, total = corrected.argmax(axis=1), corrected.sum(axis=1)
    langs, scores = [], []
    for n, text in enumerate(known):
        if not text:
            langs.append(UNKNOWN)
            scores.append(0.0)
        elif total[n] > 0:
            langs.append(model.languages[best[n]])
            scores.append(float(corrected[n, best[n]] / total[n]))
        else:
            langs.append(model.commonest)
            scores.append(0.0)
    return langs, scores


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def learn(docs: DataFrame, sample: int = SAMPLE, bits: int = BITS) -> Model:
    """A model of ``doc_id, text, lang``. Bits of one position are put together in Spark, so at most ``2**bits`` rows, one for each
    position and word of 64 languages, come here."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    rows = {row[0]: row[1] for row in labelled.groupBy("lang").count().collect()}
    languages = sorted(rows)
    if not languages:
        return Model([], np.zeros((1 << bits, 1), np.uint64), UNKNOWN)
    number = F.create_map(*[F.lit(x) for n, lang in enumerate(languages) for x in (lang, n)])
    part = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, sample / rows[lang]))])
    dice = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    chosen = labelled.where(dice < part[F.col("lang")]).select(number[F.col("lang")].alias("lang"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 1):
            langs = np.array(batch.column("lang").to_pylist())
            texts = batch.column("text").to_pylist()
            for lang in np.unique(langs):
                for _, parts in _parts([texts[n] for n in np.flatnonzero(langs == lang)]):
                    grams = np.concatenate([_grams(p) for p in parts])
                    grams, times = np.unique(grams[grams != BLANK], return_counts=True)
                    columns = [pa.array(np.full(len(grams), lang, np.int32)), pa.array(grams.astype(np.int64)), pa.array(times)]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])

    counted = chosen.mapInArrow(count, "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counted = counted.where(F.col("n") >= LEAST).persist()
    totals = {row[0]: row[1] for row in counted.groupBy("lang").agg(F.sum("n")).collect()}
    rate = F.create_map(*[F.lit(x) for n in range(len(languages)) for x in (n, 1.0 / totals.get(n, 1))])
    rated = counted.select("gram", F.struct((F.col("n") * rate[F.col("lang")]).alias("rate"), "lang").alias("of"))
    by_gram = rated.groupBy("gram").agg(F.max("of.rate").alias("most"), F.collect_list("of").alias("of"))
    kept = by_gram.select("gram", F.explode(F.filter("of", lambda x: x["rate"] >= F.col("most") * RATIO)["lang"]).alias("lang"))
    word = np.uint8 if len(languages) <= 8 else np.uint64
    wide = 8 * np.dtype(word).itemsize
    table = np.zeros((1 << bits, -(-len(languages) // wide)), word)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_numpy()
            masks = (np.uint64(1) << (langs % wide).astype(np.uint64)).view(np.int64)
            for at in _positions(batch.column("gram").to_numpy().astype(np.uint32), bits, HASHES):
                columns = [pa.array(at), pa.array((langs // wide).astype(np.int32)), pa.array(masks)]
                yield pa.RecordBatch.from_arrays(columns, ["at", "word", "mask"])

    placed = kept.mapInArrow(place, "at long, word int, mask long")
    got = placed.groupBy("at", "word").agg(F.bit_or("mask").alias("mask")).toArrow()
    counted.unpersist()
    masks = got.column("mask").to_numpy().view(np.uint64).astype(word)
    table[got.column("at").to_numpy(), got.column("word").to_numpy()] = masks
    return Model(languages, table, min(languages, key=lambda lang: (-rows[lang], lang)))


def identify(docs: DataFrame, model: Model, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of ``docs``, and the language and score of each text."""
    field, names = docs.columns.index("text"), [*docs.columns, lang, score]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, field):
            langs, scores = decide(batch.column(field).to_pylist(), model)
            columns = [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names)

    added = [T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


def predict(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row, learned from the rows that are not held out."""
    found = identify(docs.select("doc_id", "text"), learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def in_known_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those whose language can't be told: no text, or no letters."""
    lang, score = unused(docs, "_lang_pred", "_score")
    found = identify(docs, learn(docs), lang, score)
    return found.where(F.col(lang) != UNKNOWN).drop(lang, score)
