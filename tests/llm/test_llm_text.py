"""Chat formatting, URL filter, language ID."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mixloom.llm import chat, language, urls

CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "\n", "<", "[", " ", "a", "é"]


def read_back(df):
    return chat.read_chats(chat.format_chats(chat.conversations(df))).collect()


def test_turns_come_back_from_the_template(frame):
    texts = ["</s>[INST] ok [/INST]", "a\\<s> \\\\ </s>\n", None, "", "<<s>[[INST]\\", "[/INST] <s> x"]
    roles = ["user", "assistant", None, "as\nsi\\s<s>t", "assistant", "assistant"]
    given_rows = [(1, n, r, t, "extra") for n, (r, t) in enumerate(zip(roles, texts))]
    (row,) = read_back(frame("conv_id long, turn long, role string, text string, formatted string", *given_rows))
    assert [(t.role, t.text) for t in row.turns] == [(r or "", t or "") for r, t in zip(roles, texts)]
    spans = [row.formatted[s.start - 1 : s.start - 1 + s.length] for s in row.loss_spans]
    assert len(spans) == 3 and not any(c in s for s in spans for c in ("<s>", "</s>", "[INST]", "[/INST]"))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(CONTROLS), max_size=12).map("".join), min_size=40, max_size=40))
def test_any_text_comes_back(spark, texts):
    df = spark.createDataFrame(
        [(n // 4, n, "assistant" if n % 2 else t, t) for n, t in enumerate(texts)], "conv_id long, turn long, role string, text string"
    )
    for row in read_back(df):
        own = range(row.conv_id * 4, row.conv_id * 4 + 4)
        assert [(t.role, t.text) for t in row.turns] == [("assistant" if n % 2 else texts[n], texts[n]) for n in own]


def test_digests(frame):
    df = frame("conv_id long, turn long, role string, text string", (5, 1, "assistant", "é</s>"), (5, 0, "user", "q"), (5, 1, "assistant", "b"), (None, None, None, None))
    found = {r.conv_id: r for r in chat.digest_chats(chat.read_chats(chat.format_chats(chat.conversations(df)))).collect()}
    whole = "user\nq\nassistant\nb\nassistant\né</s>\n"
    assert found[5].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
    assert found[5].loss_sha256 == hashlib.sha256("bé</s>".encode()).hexdigest() and found[5].loss_chars == 6
    assert found[None].n_turns == 1 and found[None].loss_chars == 0


def test_layouts(frame):
    turn = "array<struct<role string, content string>>"
    listed = frame(f"conv_id long, messages {turn}", (1, [("user", "q"), None, ("assistant", None)]), (2, []), (3, None))
    rows = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.conversations(listed).collect()}
    assert rows == {1: [("user", "q"), ("assistant", "")], 2: [], 3: []}
    shared = frame("id long, conversations array<struct<from string, value string>>, prompt string", (1, [("human", "q"), ("gpt", "a")], "x"))
    assert [(t.role, t.text) for t in chat.conversations(shared).first().turns] == [("user", "q"), ("assistant", "a")]
    asked = frame("id long, instruction string, input string, output string", (1, "do", None, "done"))
    assert [t.text for t in chat.conversations(asked).first().turns] == ["do", "done"]
    with pytest.raises(ValueError, match="no mapping"):
        chat.conversations(frame("x long", (1,)))
    assert chat.digest_chats(chat.read_chats(chat.format_chats(chat.conversations(listed.limit(0))))).count() == 0


def test_ids_that_are_text_stay_apart(frame):
    rows = [(i, t, "user", f"{i} {t}") for i in ("a-1", "b-2", "17", None) for t in (1, 0)]
    found = chat.conversations(frame("conv_id string, turn long, role string, text string", *rows))
    read = {r.conv_key: (r.conv_id, [t.text for t in r.turns]) for r in chat.read_chats(chat.format_chats(found)).collect()}
    assert read == {
        "a-1": (None, ["a-1 0", "a-1 1"]), "b-2": (None, ["b-2 0", "b-2 1"]), "17": (17, ["17 0", "17 1"]), None: (None, ["None 0", "None 1"]),
    }
    listed = frame("conv_id string, messages array<struct<role:string,content:string>>", ("x", [("user", "q")]), ("9", [("user", "r")]))
    assert {r.conv_key: r.conv_id for r in chat.conversations(listed).collect()} == {"x": None, "9": 9}
    rows = chat.json_conversations(frame("j string", ('{"id":"t","prompt":"a","response":"b"}',), ('{"id":5,"prompt":"a","response":"b"}',)), "j")
    assert {r.conv_key: r.conv_id for r in rows.collect()} == {"t": None, "5": 5}


def test_json_rows_by_their_own_fingerprint(frame):
    texts = ['{"id":1,"prompt":"a","response":"b"}', '{"conv_id":2,"messages":[{"role":"user","content":"q"}],"x":1}', "[1]", "bad", None, '{"id":3,"conversations":[{"from":"human","value":"q"}]}']
    rows = chat.json_conversations(frame("j string", *[(t,) for t in texts]), "j").collect()
    assert [r.turns and [(t.role, t.text) for t in r.turns] for r in rows] == [
        [("user", "a"), ("assistant", "b")], [("user", "q")], None, None, None, [("user", "q")],
    ]


RULES = [urls.rule("allow", "good.org/"), urls.rule("block", "bad.com/"), urls.rule("allow", "bad.com/fine/")]


def test_rules_and_parsing(frame):
    given_urls = ["HTTPS://A.Good.ORG/x?y#z", "http://bad.com", "http://bad.com/x", "x://bad.com/fine/1", "http://notbad.com/", "no url", None, "a://b://c/d", "http://"]
    df = frame("page_id long, url string, html string, host string", *[(n, u, None, "mine") for n, u in enumerate(given_urls)])
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.filter_urls(df, RULES, 3).collect()}
    assert found == {
        0: ("a.good.org", "/x", "good.org/", "allow"), 1: ("bad.com", "", None, "block"), 2: ("bad.com", "/x", "bad.com/", "block"),
        3: ("bad.com", "/fine/1", "bad.com/fine/", "allow"), 4: ("notbad.com", "/", None, "allow"), 5: ("", "", None, "allow"),
        6: ("", "", None, "allow"), 7: ("b:", "//c/d", None, "allow"), 8: ("", "", None, "allow"),
    }
    assert urls.filter_urls(df.limit(0), RULES, 2).count() == 0


def brute_ranks(pages, rules, iterations):
    edges, seeds = {}, {"trust": {}, "distrust": {}}
    for src, path, links in pages:
        fits = [r for r in rules if (src == r.host or src.endswith("." + r.host)) and path.startswith(r.path)]
        if fits:
            kind = "trust" if max(fits, key=lambda r: len(r.name)).verdict == "allow" else "distrust"
            seeds[kind][src] = seeds[kind].get(src, 0) + 1
        for dst in links:
            if dst != src:
                edges[src, dst] = edges.get((src, dst), 0) + 1
    out = {}
    for kind, own in seeds.items():
        way = {((a, b) if kind == "trust" else (b, a)): w for (a, b), w in edges.items()}
        total = {}
        for (a, _), w in way.items():
            total[a] = total.get(a, 0) + w
        base = {h: int(urls.MASS * (n / sum(own.values()))) for h, n in own.items()}
        rank = dict(base)
        for _ in range(iterations):
            inflow = {}
            for (a, b), w in way.items():
                if a in rank:
                    inflow[b] = inflow.get(b, 0) + int(rank[a] * (w / total[a]))
            new = {h: int(s * (1 - urls.DAMPING)) for h, s in base.items()}
            for h, x in inflow.items():
                new[h] = new.get(h, 0) + int(x * urls.DAMPING)
            rank = new
        out[kind] = {h: int(r * (urls.MASS / sum(rank.values()))) for h, r in rank.items() if r}
    return out


def test_trust_and_distrust_follow_links(frame):
    pages = [
        ("good.org", "/", ["friend.net", "friend.net", "other.net"]), ("friend.net", "/", ["far.net"]), ("spam.net", "/", ["bad.com", "friend.net"]),
        ("farm.net", "/", ["spam.net"]), ("bad.com", "/x", ["good.org"]), ("other.net", "/", []), ("far.net", "/", ["far.net"]),
    ]
    html = lambda links: "".join(f'<a href="https://{h.upper()}/p">x</a><img src=//{h}>' for h in links)
    df = frame("page_id long, url string, html string", *[(n, f"http://{h}{p}", html(ls)) for n, (h, p, ls) in enumerate(pages)])
    found = {r.host: r for r in urls.filter_urls(df, RULES, 5).collect()}
    expected = brute_ranks([(h, p, ls * 2) for h, p, ls in pages], RULES, 5)
    assert {h: (r.trust, r.distrust) for h, r in found.items()} == {h: (expected["trust"].get(h, 0), expected["distrust"].get(h, 0)) for h in found}
    assert found["friend.net"].verdict == found["far.net"].verdict == "allow"
    assert found["spam.net"].verdict == found["farm.net"].verdict == "block"


def exact_ranks(way, seeds, rounds=400):
    """Personalised PageRank in floats; what reaches a host without links goes back to the seeds."""
    total = {}
    for (a, _), w in way.items():
        total[a] = total.get(a, 0) + w
    rank = dict(seeds)
    for _ in range(rounds):
        lost = sum(r for h, r in rank.items() if h not in total)
        new = {h: s * (1 - urls.DAMPING + urls.DAMPING * lost) for h, s in seeds.items()}
        for (a, b), w in way.items():
            new[b] = new.get(b, 0) + urls.DAMPING * rank.get(a, 0) * w / total[a]
        rank = new
    return rank


def test_ranks_settle_on_a_random_graph(frame):
    """Some 200 hosts with sinks, cycles and a chain longer than any fixed number of rounds would follow."""
    rng = random.Random(8)
    hosts = [f"h{n}.net" for n in range(200)]
    links = {h: [rng.choice(hosts) for _ in range(rng.choice([0, 0, 1, 2, 5]))] for h in hosts}
    chain = [f"c{n}.net" for n in range(40)]
    links |= {a: [b] for a, b in zip(chain, chain[1:])} | {"good.org": [hosts[0], chain[0]], "bad.com": [hosts[1]], "x.good.org": [hosts[2]]}
    for h in hosts[3:9]:
        links[h] = [*links[h], "bad.com"]
    pages = [(n, f"http://{h}/", "".join(f'<a href="http://{x}/">' for x in own)) for n, (h, own) in enumerate(links.items())]
    found = {r.host: r for r in urls.filter_urls(frame("page_id long, url string, html string", *pages), RULES).collect()}
    edges = {}
    for a, own in links.items():
        for b in own:
            if a != b:
                edges[a, b] = edges.get((a, b), 0) + 1
    trust = exact_ranks(edges, {"good.org": 0.5, "x.good.org": 0.5})
    distrust = exact_ranks({(b, a): w for (a, b), w in edges.items()}, {"bad.com": 1.0})
    for h, r in found.items():
        assert abs(r.trust / urls.MASS - trust.get(h, 0)) < 1e-5 and abs(r.distrust / urls.MASS - distrust.get(h, 0)) < 1e-5
    assert found[chain[-2]].trust > 0 and found[chain[-2]].verdict == "allow"


def test_language(spark, frame):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.learn(docs)
    odd = frame("doc_id long, text string, lang string, score double", (1, None, "en", 0.1), (2, "12 !?", "en", None), (None, "", None, None), (3, "Щ", "x", None))
    found = language.identify(odd, model, "p", "s").collect()
    assert [r.p for r in found] == ["und", "und", "und", "en"] and all(r.s == 0 for r in found)
    predicted = language.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in predicted) / len(predicted) > 0.98
    assert all(0 <= r.score <= 1 for r in predicted)
    kept = language.in_known_language(odd.withColumn("lang", F.lit("en")))
    assert kept.columns == odd.columns
    assert language.predict(odd.limit(0)).count() == 0


def test_language_filters_return_all_languages_of_an_ngram():

    table = np.zeros((1 << 12, 2), np.uint64)
    model = language.Model([f"l{n:02}" for n in range(70)], table, "l00")
    grams = language._grams(language._padded("word"))
    for at in language._positions(grams, model.bits, model.hashes):
        table[at, 0] |= np.uint64(1 << 3)
        table[at, 1] |= np.uint64(1 << 5)
    n_grams, found = language.counts(["word", "WORD " * 3, "x" * (1 << 21)], model)
    assert n_grams[0] == len(grams) and found[0, 3] == found[0, 69] == n_grams[0] and found[0].sum() == 2 * n_grams[0]
    assert n_grams[2] == (1 << 21) + 3


def test_letters_are_no_numbers():
    given = ["", None, "12 ½ ² Ⅷ _ -", "½ é", "٣", "日", "\u0301", "ª"]
    assert [language.has_letter(t) for t in given] == [False, False, False, True, False, True, False, True]


def test_slices_of_batches_keep_all_rows_in_order():
    import pyarrow as pa

    from mixloom.llm.base import in_slices

    texts = ["ab", None, "", "long" * 50, "é", "x" * 9, None]
    batches = [pa.record_batch({"n": pa.array(range(k, k + len(t))), "text": pa.array(t, pa.string())}) for k, t in ((0, texts), (7, []), (7, ["z"]))]
    slices = list(in_slices(iter(batches), 1, most=10))
    assert [r for s in slices for r in s.to_pylist()] == [r for b in batches for r in b.to_pylist()]
    assert [s.num_rows for s in slices] == [4, 2, 1, 1]


def test_filters_hold_what_few_rows_taught(frame):
    """With 70 languages the filters have two words; each n-gram of a language's own text is in its filter."""
    names = [f"l{n:02}" for n in range(70)]
    docs = frame("doc_id bigint, text string, lang string", *[(d, f"{chr(97 + n % 26)}{chr(97 + n // 26)}zq " * 9, lang) for n, lang in enumerate(names) for d in (n * 8, n * 8 + 1, n * 8 + 2, n * 8 + 3)])
    model = language.learn(docs, bits=14)
    assert model.languages == names and model.table.shape == (1 << 14, 2) and model.table.dtype == np.uint64
    for n in (0, 1, 63, 64, 69):
        n_grams, found = language.counts([f"{chr(97 + n % 26)}{chr(97 + n // 26)}zq "], model)
        assert n_grams[0] > 0 and found[0, n] == n_grams[0]
