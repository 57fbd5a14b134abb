"""Pipeline stages on awkward tables: clashing names, repeated rows, null ids, one id in two sources, no rows."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from mixloom.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"
# Names that the stages' own columns have or are made from.
NAMES = [
    *["_id", "_key", "_k", "_mine", "_take", "_text_key", "_lang_pred", "_score", "lang_pred", "score", "key", "size", "start", "rank"],
    *["copies", "spans", "pass", "fp", "fingerprint", "component_id", "text_key", "first_key", "digest", "_own0", "_of1", "_ROW"],
]
LONG = "a passage of one hundred and one words that goes on " * 9


def table(frame, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in NAMES)
    return frame(schema, *[(*r, len(r[1] or ""), *[f"{n} of {r[0]}" for n in NAMES]) for r in rows])


def rows():
    made = [(n, f"{LONG} number {n} " + "and so on " * (n % 7), "en", "ab"[n % 2]) for n in range(20)]
    made += [(n + 40, f"voilà un texte {n} d'une autre langue " * (1 + n % 5), "fr", "c") for n in range(12)]
    made += [(None, "no id but words", "en", "a"), (None, "no id but words", "en", "a"), (60, None, "en", "a"), (61, "", None, None)]
    made += [(62, "no source here", None, None), (63, "two sources", "en", "a"), (63, "two sources", "en", "b")]
    return made + [(64, "three times over", "en", "b")] * 3 + [(65, "other columns differ", "en", "b")] * 2


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_keep_columns_whatever_their_names(spark, frame, name, stage):
    df = table(frame, rows())
    out = stage(spark, df, SF)
    if name == "sharding":
        assert out.count() == df.count()
    else:
        assert out.columns == df.columns and out.dtypes == df.dtypes
        for r in out.collect():
            assert all(r[n] == f"{n} of {r.doc_id}" for n in NAMES)
            assert r.n_chars == len(r.text or "")
    empty = stage(spark, df.limit(0), SF)
    assert empty.count() == 0


def test_dedup_keeps_one_of_repeated_rows_and_the_same_each_time(frame):
    df = table(frame, rows())
    altered = df.withColumn("size", df._k).unionByName(df.where("doc_id = 64").withColumn("lang", df._k))
    found = [Counter(tuple(r) for r in corpus_pipeline.simhash.one_per_group(altered.repartition(n)).collect()) for n in (1, 5)]
    assert found[0] == found[1] and max(found[0].values()) == 1
    assert Counter(r[0] for r in found[0] if r[0] is not None).most_common(1)[0][1] == 1


def test_mixed_documents_of_repeated_rows(frame):
    """Repeats count once, and each source gives the words of its target."""
    df = table(frame, rows())
    mixed = mixing.mixed_documents(df, block=16).collect()
    once = mixing.mixed_documents(df.dropDuplicates(["doc_id", "source", "text"]), block=16).collect()
    assert Counter(map(tuple, mixed)) == Counter(map(tuple, once))
    size, given = {}, {}
    for doc_id, text, _, source in set(rows()):
        n = len(WORD.findall(text or ""))
        size[source] = size.get(source, 0) + n
        given[(doc_id, source, text)] = n
    order = sorted(size, key=lambda s: (s is None, s or ""))
    target = dict(zip(order, mixing.targets([size[s] for s in order])))
    taken = Counter()
    for r in mixed:
        taken[r.source] += len(WORD.findall(r.text))
    assert {s: taken[s] for s in order} == {s: round(target[s]) for s in order}
    own = Counter()
    for r in mixing.mix(df.dropDuplicates(["doc_id", "source", "text"]), block=16).collect():
        own[(r.doc_id, r.source)] += r.n
    held = Counter()
    for r in mixed:
        held[(r.doc_id, r.source)] += len(WORD.findall(r.text))
    assert held == +own
    most = Counter()
    for (doc_id, source, _), n in given.items():
        most[(doc_id, source)] += n
    assert all(n <= 2 * most[k] for k, n in held.items())


def test_mixing_simulated_slot_by_slot(frame):
    """Blocks, slots, permutation and passes by hand: the words of each document that the mix holds."""
    df = table(frame, rows()).dropDuplicates(["doc_id", "source", "text"])
    spark = df.sparkSession
    block = 16
    sized = mixing._sized(df)
    sources = mixing.source_table(sized)
    placed = mixing._placed(sized, sources).collect()
    held = Counter()
    for s in mixing.slots(spark, sources, block).collect():
        lo, hi = s.block * block, s.block * block + s.words
        for d in placed:
            if d["rank"] == s["rank"]:
                held[(d.doc_id, d.source)] += max(0, min(hi, d.start + d["size"]) - max(lo, d.start))
    assert +held == Counter({k: n for k, n in _by_document(mixing.mixed_documents(df, block=block)).items()})


def _by_document(mixed):
    out = Counter()
    for r in mixed.collect():
        out[(r.doc_id, r.source)] += len(WORD.findall(r.text))
    return out
