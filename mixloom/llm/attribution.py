"""Token counts of fields and sections, by the places of tokens in the whole document.

A document is its fields joined by line breaks; each field is divided into lines, with the break that ends them, as its
sections. The document is encoded once. Each token, with its span of characters, is joined to the sections that it overlaps
(both are ordered, so by binary search). A token over several sections is allocated by a rule: ``most`` (the
default) to the section with most of its characters, the first of equal ones; ``first`` to that of its first
character; ``share`` to each by its part of the characters.

A null field is empty. An empty field is one empty section with no tokens. A break between fields belongs to the section
before it. Repeated rows are counted each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.llm.tokens import spans, token_bytes, worker_encoder


def sections(fields: list[str]) -> tuple[str, list[tuple[int, int]], np.ndarray]:
    """The document, (field, number) of each section, and where sections begin, with the document's end."""
    names, starts, at = [], [], 0
    for n, text in enumerate(fields):
        lines = text.split("\n")
        if len(lines) > 1 and not lines[-1]:
            lines.pop()
        place = at
        for k, line in enumerate(lines):
            names.append((n, k))
            starts.append(place)
            place += len(line) + 1
        at += len(text) + 1
    document = "\n".join(fields)
    return document, names, np.array([*starts, len(document)], np.int64)


def allocate(first: np.ndarray, end: np.ndarray, bounds: np.ndarray, rule: str = "most") -> np.ndarray:
    """Tokens of each section; ``bounds`` are their begins and the end of the last."""
    out = np.zeros(len(bounds) - 1)
    if not len(first):
        return out
    low = np.searchsorted(bounds, first, side="right") - 1
    high = np.searchsorted(bounds, np.maximum(end - 1, first), side="right") - 1
    low, high = np.minimum(low, len(out) - 1), np.minimum(high, len(out) - 1)
    alone = (low == high) | (rule == "first")
    out += np.bincount(low[alone], minlength=len(out))
    for t in np.flatnonzero(~alone):
        own = np.arange(low[t], high[t] + 1)
        part = np.minimum(end[t], bounds[own + 1]) - np.maximum(first[t], bounds[own])
        if rule == "share":
            out[own] += part / part.sum()
        else:
            out[own[part.argmax()]] += 1
    return out


STRETCH = 1 << 20


def _stretches(numbers: list[int], texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts, with their numbers, of some ``STRETCH`` characters at a time."""
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size < STRETCH):
            size += len(texts[to])
            to += 1
        yield numbers[at:to], texts[at:to]
        at = to


def attribute(docs: DataFrame, definition: str, fields: list[str], kind: str = "bytes", rule: str = "most") -> DataFrame:
    """``doc_id, field, section, start, end, n_tokens`` for each section of each row of ``docs``.

    Places count characters of the document; ``definition`` is the tokenizer's JSON.
    """
    if rule not in ("most", "first", "share"):
        raise ValueError(f"no such rule: {rule}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(definition, kind)
        sizes = token_bytes(encoder.tokenizer)
        for batch in batches:
            columns = [batch.column(n + 1).to_pylist() for n in range(len(fields))]
            parts = [sections([f or "" for f in row]) for row in zip(*columns)]
            numbers = list(range(len(parts)))
            out: list[tuple] = []
            doc_ids = batch.column(0).to_pylist()
            for own, texts in _stretches(numbers, [p[0] for p in parts]):
                plain = [t if kind == "bytes" and encoder.plain(t) else "" for t in texts]
                for n, text, fits, ids in zip(own, texts, plain, encoder.encode(plain)):
                    if fits:
                        first, end = spans(text, ids, sizes)
                    else:
                        places = encoder.tokenizer.encode(text, add_special_tokens=False).offsets
                        first, end = np.array(places, np.int64).reshape(-1, 2).T
                    _, names, bounds = parts[n]
                    got = allocate(first, end, bounds, rule)
                    out += [
                        (doc_ids[n], fields[f], k, int(a), int(b), float(c))
                        for (f, k), a, b, c in zip(names, bounds, bounds[1:], got)
                    ]
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.float64())
            names = ["doc_id", "field", "section", "start", "end", "n_tokens"]
            rows = list(zip(*out)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names)

    plain = docs.select(
        F.col("doc_id").cast("long").alias("_id"), *[F.col(f).cast("string").alias(f"_f{n}") for n, f in enumerate(fields)]
    )
    return plain.mapInArrow(run, "doc_id long, field string, section int, start long, end long, n_tokens double")
