"""Classifiers, personal data, page text, chat, licences and packing against brute force, and odd rows."""

import collections
import hashlib
import html
import json
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendloom.llm import chat, hosttext, langid, licences, packing, queries, sanitise, toxicity
from spendloom.llm.common import learns, pick, table

DOCS = "doc_id bigint, text string"
ODD = [(1, None), (2, ""), (3, "..."), (4, "hello"), (4, "hello"), (None, "word"), (5, "long word " * 20000), (6, "é" * 300)]


# --- helpers ----------------------------------------------------------------


def test_pick_finds_exact_names(spark):
    df = spark.sql("SELECT 1 AS DOC_ID, 2 AS doc_id, 'a' AS Text, 'b' AS text")
    assert [tuple(r) for r in pick(df, "doc_id", "text").collect()] == [(2, "b")]


def test_learns_by_checksum(spark):
    got = spark.range(50).select("id", learns(F.col("id")).alias("l")).collect()
    assert all(r.l == (zlib.crc32(str(r.id).encode()) % 5 != 0) for r in got)


# --- toxicity ---------------------------------------------------------------


def auc(good, bad):
    good, bad = np.array(good), np.array(bad)
    return (good[:, None] > bad[None]).mean() + (good[:, None] == bad[None]).mean() / 2


def test_toxicity_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = queries.QUERIES["op3_toxicity"](spark, sf_dir).where("held_out").join(table(spark, sf_dir, "labels"), "doc_id").collect()
    assert auc([r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]) > 0.85
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_toxicity_of_odd_rows(make):
    rng = np.random.default_rng(3)
    plain = [" ".join(f"w{rng.integers(0, 300)}" for _ in range(60)) for _ in range(400)]
    bad = [f"{t} vilest scoundrel ever vilest" for t in plain[:80]]
    model = toxicity.Model(bad[:60], plain[80:])
    docs = make([(k, t, 0.5) for k, t in ODD + [(7, bad[70])]], DOCS + ", score double")
    rows = toxicity.score(docs, model, into="score_").collect()
    assert len(rows) == len(ODD) + 1 and all(0 <= r.score_ <= 1 for r in rows)
    assert max(rows, key=lambda r: r.score_).doc_id == 7
    none = toxicity.fit(make([], DOCS), make([], "doc_id bigint, toxic int"))
    assert [r.score for r in toxicity.score(make(ODD, DOCS), none).collect()] == [0.0] * len(ODD)
    assert toxicity.score(make([], DOCS), model).collect() == []


# --- language ---------------------------------------------------------------


def test_backpropagation_matches_differences():
    network = langid.Network(["a", "b"], hidden=4)
    data = np.frombuffer(b"the cat sat on the mat, and der Hund", np.uint8).reshape(18, 2)
    label = np.array([0, 1])
    _, grads = network.gradients(data, label)
    for name, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, ends = network.params[name][at], []
        for step in (1e-2, -1e-2):
            network.params[name][at] = old + step
            ends.append(network.gradients(data, label)[0])
        network.params[name][at] = old
        assert abs((ends[0] - ends[1]) / 2e-2 - g[at]) < 1e-3 + 0.05 * abs(g[at])


def test_chunks_label_every_byte_once():
    network = langid.Network(["a", "b"])
    texts = [b"x" * n for n in (1, langid.CHUNK - 2 * langid.MARGIN, 1000)]
    np.testing.assert_allclose(network.documents(texts).sum(1), 1, atol=1e-5)
    assert network.documents([b"", b"..."]).tolist() == [[0, 0], [0, 0]]


def test_language_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op4_language"](spark, sf_dir).where("held_out").join(table(spark, sf_dir, "documents"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97


def test_language_of_odd_rows(make):
    network = langid.Network(["de", "en"])
    docs = make([(k, t, "x") for k, t in ODD], DOCS + ", lang_pred string")
    rows = langid.predict(docs, network, into=("language", "score")).collect()
    assert [r.language for r in rows[:3]] == ["und"] * 3 and all(r.language in ("de", "en") for r in rows[3:])
    assert all(0 <= r.score <= 1 for r in rows)
    empty = make([], DOCS + ", lang string")
    assert langid.fit(empty) is None
    assert {r.lang_pred for r in langid.predict(make(ODD, DOCS), None).collect()} == {"und"}


# --- page text --------------------------------------------------------------


def article(page):
    """Blocks of the article of the test pages' one template."""
    inner = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1]
    parts = [re.sub(r"<[^>]*(>|\Z)", "", x.replace("<br>", " ")) for x in re.split(r"</?(?:h1|p)>", inner)]
    return "\n".join(t for x in parts if (t := " ".join(html.unescape(x).split())))


def test_text_of_pages(spark, sf_dir):
    got = {r.page_id: (r.text, r.n_chars) for r in queries.QUERIES["op5_main_text"](spark, sf_dir).collect()}
    for r in table(spark, sf_dir, "pages").collect():
        assert got[r.page_id] == (article(r.html), len(article(r.html)))


PAGES = "page_id bigint, url string, html string"


def test_zones_of_a_page():
    page = """<body class="has-sidebar"><header>Site</header><nav>Menu</nav><div class='cookie-notice'>We use</div>
    <main><article><header><h1>Title &amp; more</h1></header><p>One<b>two</b> three<p>four<ul><li>a<li>b</ul>
    <aside>Also</aside><form>Mail <input></form><div hidden>no</div><script>if (a < b) "</article>"</script>
    <table><tr><td>x<td>y</table></article><section id="comments"><article>Me too</article></section></main>
    <footer>&copy; us</footer>"""
    zoned = hosttext.blocks(page)
    assert [t for t, z in zoned if z == hosttext.MAIN] == ["Title & more", "Onetwo three", "four", "a", "b", "x", "y"]
    assert hosttext.blocks(None) == hosttext.blocks("") == []
    assert hosttext.blocks("a <b") == [("a", hosttext.OPEN)] and hosttext.blocks("1 < 2 &am") == [("1 < 2 &am", hosttext.OPEN)]


def test_boilerplate_of_a_host(make):
    side = "".join(f"<div>Link {w} here now</div>" for w in ("alpha", "beta", "gamma", "delta"))
    body = lambda i: " ".join(f"w{i}x{k}" for k in range(30))
    rows = [(i, f"http://h.example/{i}", f"<div>{side}</div><div>{body(i)}</div>") for i in range(8)]
    rows += [(8, "http://other.example/", f"<div>{side}</div>"), (9, None, None), (10, None, ""), (0, rows[0][1], rows[0][2])]
    got = hosttext.extract(make([(*r, "clash") for r in rows], PAGES + ", host string")).collect()
    assert len(got) == len(rows)
    for r in got:
        want = body(r.page_id) if r.page_id < 8 else "\n".join(re.findall(r"Link \w+ here now", side)) if r.page_id == 8 else ""
        assert r.text == want
    assert hosttext.extract(make([], PAGES)).collect() == []


def test_boilerplate_inside_declared_articles(make):
    """The host's runs decide in articles too; paragraphs and headings stay though they repeat."""
    again = "this very sentence stands in each article of the host"
    offer = "get our letter by mail every week and never miss a story"
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(30))
    page = lambda i: f"<nav>{offer} now</nav><article><h2>{again}</h2><div>{own(i)}</div><p>{again}</p><div>{offer}</div><ul><li>{own(i)} a</ul></article>"
    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(8)] + [(8, "http://other.example/", page(8))]
    for r in hosttext.extract(make(rows, PAGES)).collect():
        want = [again, own(r.page_id), again, *([offer] if r.page_id == 8 else []), own(r.page_id) + " a"]
        assert r.text == "\n".join(want)


def test_runs_of_a_host_are_counted_over_its_shards(make):
    """A notice on few of a large host's pages goes wherever they are dealt; copies of a page don't make one."""
    notice = "this shop is closed on all the days of the fair"
    twice = "only two of the pages have this line though one comes often"
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(30))
    body = lambda i: f"<div>{own(i)}</div>" + (f"<div>{notice}</div>" if i % 8 == 0 else f"<div>{twice}</div>" if i in (1, 2) else "")
    rows = [(i, f"http://h.example/{i}", body(i)) for i in range(24)] + [(100 + i, "http://h.example/copy", body(1)) for i in range(9)]
    rows += [(50 + i, "http://other.example/", f"<div>{notice}</div><div>{own(i)}</div>") for i in range(2)] + [(60, "http://h.example/none", None)]
    for size in (300, 1 << 20):
        got = hosttext.extract(make(rows, PAGES), shard_bytes=size).collect()
        assert len(got) == len(rows)
        for r in got:
            i = 1 if r.page_id >= 100 else r.page_id
            want = [notice] * (i in (50, 51)) + [own(i - 50 if i >= 50 else i)] + [twice] * (i in (1, 2))
            assert r.text == ("" if i == 60 else "\n".join(want))


def test_shards_of_a_host_change_nothing(make):
    rng = random.Random(5)
    block = lambda: f"<div>{' '.join(rng.choices('aaab', k=rng.randrange(1, 20)))}</div>"
    rows = [(i, f"http://{rng.choice('hhhi')}.example/", "".join(block() for _ in range(rng.randrange(4)))) for i in range(80)]
    rows += rng.choices(rows, k=20)
    whole, parts = (sorted(map(tuple, hosttext.extract(make(rows, PAGES), shard_bytes=n).collect())) for n in (1 << 22, 400))
    kept = sum(len(t.split("\n")) for *_, t in whole if t)
    assert parts == whole and 0 < kept < sum(len(hosttext.blocks(r[2])) for r in rows) * 0.9


def test_covered_by_brute_force():
    rng = random.Random(4)
    for _ in range(30):
        pages = [[" ".join(rng.choices("ab", k=rng.randrange(0, 14))).strip() or "a" for _ in range(rng.randrange(1, 4))] for _ in range(8)]
        unlike = list(dict.fromkeys(map(tuple, pages)))
        least = max(hosttext.LEAST_PAGES, math.ceil(hosttext.SHARE * len(unlike)))
        streams = {p: [*sum(([(w, b, k) for k, w in enumerate(t.split())] + [(None, b, -1)] for b, t in enumerate(p)), []), ((p,), -1, -1)] for p in unlike}
        on = collections.defaultdict(set)
        runs = [(p, tuple(s[i : i + hosttext.RUN])) for p, s in streams.items() for i in range(len(s) - hosttext.RUN + 1)]
        for p, run in runs:
            on[tuple(x[0] for x in run)].add(p)
        hit = {(p, b, k) for p, run in runs if len(on[tuple(x[0] for x in run)]) >= least for _, b, k in run if k >= 0}
        want = [[sum((tuple(p), b, k) in hit for k in range(len(t.split()))) / len(t.split()) for b, t in enumerate(p)] for p in pages]
        assert hosttext.covered(pages) == want


def test_long_pages_are_linear():
    assert hosttext.blocks("<p>" * 20000 + 'x <a href="' * 5000)[0][1] == hosttext.OPEN
    assert hosttext.blocks("<div>" * 50000 + "deep") == [("deep", hosttext.OPEN)]


# --- personal data ----------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def base(text):
    found = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".") if kind == "ip"),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]:
                found.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for *_, s in sorted(found))


TRICKY = [
    "a@b.com_x@c.de x@y@z.com aa@@b.com a@b_c@d.com .@-.- q@w.", "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.001 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111  1111", "+1 (873) 555-9509 +44.20.7946.0958+49 30 901820 +1 2",
    "é😀 a@b.co 😀 1.1.1.1", "1 " * 30000, "7" * 50000, "a." * 40000 + "@", "+1" * 1000,
]


def test_base_spans_are_looked_for_once(make, monkeypatch):
    """No later step searches all texts for base spans again."""
    near = lambda i: " ".join(f"w{i}x{k}" for k in range(40)) + " codename zebra mail a.b@c.example now"
    rows = [(i, near(i)) for i in range(8)] + [(100 + i, f"plain text w{i} here {i}") for i in range(300)] + [(500, "the zebra sleeps")]
    plans, kept = {}, sanitise.written

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return kept(df, name)

    monkeypatch.setattr(sanitise, "written", seen)
    spans = {r.doc_id: [s.kind for s in r.spans] for r in sanitise.find(make(rows, DOCS)).collect()}
    assert spans[500] == [4] and spans[0] == [4, 4, 4, 0, 4] and spans[100] == []
    pattern = sanitise.PATTERNS["ip"]
    assert pattern in plans["entities"]
    assert not [n for n in ("vocabulary", "texts-told", "texts-marked") if pattern in plans[n]]


def test_base_spans_of_tricky_texts(make):
    rows = [(i, t) for i, t in enumerate(TRICKY)] + ODD
    got = make(rows, DOCS).select("text", sanitise.joined_spans(sanitise.base_spans(F.coalesce("text", F.lit("")))).alias("s")).collect()
    assert [(r.text, r.s) for r in got] == [(t, base(t)) for _, t in rows]


def test_base_spans_of_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    want = {r.doc_id: hashlib.sha256(base(r.text).encode()).hexdigest() for r in table(spark, sf_dir, "documents").collect()}
    got = queries.QUERIES["op6_personal_data"](spark, sf_dir).collect()
    assert {r.doc_id: r.base_sha256 for r in got} == want and any(r.n_email for r in got)


def disclosing():
    """Quokka stands near one address alone; today stands everywhere."""
    rows = [(i, f"today n{i} wrote: quokka ann@x.org today n{i + 50}") for i in range(4)]
    return rows + [(10 + i, f"today it was n{i}") for i in range(60)] + [(100, "bob@y.org today"), (101, None)]


def test_terms_that_disclose(make):
    rows = disclosing()
    got = {r.doc_id: r for r in sanitise.find(make([(*r, "x") for r in rows], DOCS + ", digest string")).collect()}
    for key, text in rows[:4]:
        terms = {text[s.start : s.end]: s.value for s in got[key].spans if s.kind == 4}
        assert terms["quokka"] == "remove" and "today" not in terms
    assert got[101].spans == [] and len(got) == len(rows)
    none = sanitise.find(make([], DOCS))
    assert none.collect() == []


def test_terms_far_from_their_entity(make):
    # Of other words each time: near copies would be one text.
    far = ["".join(f" and so{k}x{i}" for i in range(40)) for k in range(4)]
    rows = [(i, f"Bob x{i} 李明{far[i]} ann@x.org, x.org") for i in range(2)] + [(2, f"today bob, or {far[2]}"), (3, "seen: 李明")]
    rows += [(10 + i, f"today it was y{i} {far[3]}") for i in range(400)]
    got = {r.doc_id: r for r in sanitise.find(make(rows, DOCS)).collect()}
    terms = {key: {text[s.start : s.end] for s in got[key].spans if s.kind == 4} for key, text in rows}
    assert {"Bob", "李明"} <= terms[0] == terms[1] and terms[2] == {"bob"} and terms[3] == {"李明"}
    assert not any(terms[key] for key, _ in rows[4:])
    texts = {r.doc_id: r.text for r in sanitise.sanitise(make(rows, DOCS)).collect()}
    assert all("bob" not in t.lower() and "李明" not in t for t in texts.values()) and texts[10] == rows[4][1]


def test_copies_prove_no_term(make):
    rows = [(i, "quokka ann@x.org") for i in range(5)] + [(10 + i, f"today it was n{i}") for i in range(400)]
    assert not any(s.kind == 4 for r in sanitise.find(make(rows, DOCS)).collect() for s in r.spans)


def test_near_copies_prove_no_term(make):
    """Twenty near copies with one address, each with another reference number, leave the words of the others alone."""
    rng = random.Random(3)
    common = [f"w{i}" for i in range(300)]
    said = "the wooden copper orchard garden report of last year was read again by all of them " + " ".join(rng.sample(common, 40))
    rows = [(i, f"{said} ref {rng.randrange(1 << 30)} ann@x.org") for i in range(20)]
    rows += [(100 + i, " ".join(rng.sample(common, 30))) for i in range(1500)]
    rows += [(5000 + i, f"{w} stood in the {' '.join(rng.sample(common, 20))}") for i, w in enumerate(["wooden", "copper", "orchard", "garden"] * 10)]
    found = sanitise.find(make(rows, DOCS)).collect()
    assert not any(s.kind == 4 for r in found for s in r.spans)
    assert sum(len(r.spans) for r in found) == 20
    out = {r.doc_id: r.text for r in sanitise.sanitise(make(rows, DOCS)).collect()}
    assert all(out[k] == t for k, t in rows[20:])


def brute_terms(rows, alpha):
    """PMI over information, and the binomial bound, by text; rows are unlike texts with lower-case words."""
    texts = [(set(re.findall(r"[a-z]+@[a-z.]+", t)), set(re.findall(r"[a-z0-9]+", re.sub(r"[a-z]+@[a-z.]+", " ", t)))) for _, t in rows]
    n = len(texts)
    n_e = collections.Counter(e for es, _ in texts for e in es)
    n_t = collections.Counter(t for _, ts in texts for t in ts)
    both = collections.Counter((e, t) for es, ts in texts for e in es for t in ts)
    tested = [e for e, m in n_e.items() if m > 1]
    pairs = len(tested) * max(1, sum(k > 1 for k in n_t.values()))
    best = {}
    for (e, t), k in both.items():
        m, q = n_e[e], n_t[t] / n
        if m < 2 or n_t[t] < 2:
            continue
        disclosure = math.log(k * n / (n_t[t] * m)) / math.log(n / m)
        bound = -(k * math.log(k / (m * q)) + ((m - k) * math.log((m - k) / (m * (1 - q))) if k < m else 0)) if k > m * q else 0
        if disclosure >= sanitise.GENERALISE and bound + math.log(pairs) <= math.log(alpha):
            best[t] = max(best.get(t, 0), disclosure)
    return {t: "remove" if d >= sanitise.REMOVE else "generalise" for t, d in best.items()}


def test_terms_are_those_of_the_formula(make):
    rng = random.Random(11)
    common = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(900):
        words = rng.sample(common, 25)
        if i % 30 < 3:
            e = i % 3
            words += [f"{'abc'[e]}nn@x.org"] + [f"own{e}"] * (rng.random() < 0.9) + [f"half{e}"] * (rng.random() < 0.8) + ["shared"]
        elif rng.random() < 0.02:
            words += [rng.choice(["half0", "half1", "half2", "shared"])]
        rows.append((i, " ".join(words)))
    want = brute_terms(rows, sanitise.ALPHA)
    assert {"own0", "own1", "own2"} <= set(want) and len(set(want.values())) == 2
    got = {}
    for r in sanitise.find(make(rows, DOCS)).collect():
        text = rows[r.doc_id][1]
        told = {text[s.start : s.end]: s.value for s in r.spans if s.kind == 4}
        assert told == {t: d for t, d in want.items() if t in text.split()}
        got |= told
    assert got == want


def test_masked_texts(make):
    rows = [(k, t, None if t is None else len(t)) for k, t in [*disclosing(), (200, "1.1.1.1 c@d.ee é 1.1.1.1 "), (200, "plain")]]
    out = sanitise.sanitise(make(rows, DOCS + ", n_chars bigint"))
    assert out.columns == ["doc_id", "text", "n_chars"]
    texts = collections.defaultdict(list)
    for r in out.collect():
        assert r.n_chars == (None if r.text is None else len(r.text))
        texts[r.doc_id].append(r.text)
    assert sorted(texts[200]) == ["[IP] [EMAIL] é [IP] ", "plain"]
    assert "quokka" not in texts[0][0] and "ann@x.org" not in texts[0][0] and "today" in texts[0][0]
    assert len(rows) == sum(map(len, texts.values()))


# --- chat -------------------------------------------------------------------


def test_conversations_round_trip(spark, sf_dir):
    said = "\\### Assistant: </turn> ok"
    turns = collections.defaultdict(list)
    for r in table(spark, sf_dir, "conversations").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text or ""))
    turns[-7] = [(0, "user", said), (1, "assistant", said)]
    got = {r.conv_id: r for r in queries.QUERIES["op7_chat"](spark, sf_dir).collect()}
    assert set(got) == set(turns)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for key, rows in turns.items():
        learned = "".join(t for _, role, t in sorted(rows) if role == "assistant")
        r = got[key]
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(rows), len(learned), sha(learned))
        assert r.turns_sha256 == sha("".join(f"{role}\n{t}\n" for _, role, t in sorted(rows)))


def test_escapes_are_reversible(make):
    texts = ["", "\\", "####", "#", "</turn>", "<\\/turn>", "\\#\\", "a </turn>\n### user: b", "ends with < ", "# \\\\### x", "<</turn>>"]
    rows = [(i // 3, i, f"r:{t}" if i % 2 else "assistant", t) for i, t in enumerate(texts)] + [(None, None, None, None), (None, None, None, None)]
    df = make(rows, "conv_id bigint, turn bigint, role string, text string")
    payload = F.expr("to_variant_object(struct(conv_id, turn, role, text))")
    read = chat.read_back(chat.formatted(chat.turns(df.select(F.col("conv_id").alias("record"), payload.alias("payload")))))
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in read.collect()}
    want = collections.defaultdict(list)
    for key, _, role, text in rows:
        want[key].append((role or "", text or ""))
    assert got == dict(want)
    assert all("</turn>" not in x for r in make([(t,) for t in texts], "t string").select(chat.escaped(F.col("t"))).collect() for x in r)


def test_layouts_by_fingerprint(make):
    records = [
        '{"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b", "extra": 1}], "id": 3}',
        '{"system": "s", "conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": null}]}',
        '{"instruction": "do", "input": "it", "output": "done"}',
        '{"prompt": "p", "completion": "c", "meta": {"prompt": 1}}',
        '{"prompt": "p", "response": "c"}',
        '{"question": "q", "answer": "a"}',
        '{"nothing": 1}', '[]', '{"messages": []}', 'null',
    ]
    df = make([(i, r) for i, r in enumerate(records)], "record bigint, json string").select("record", F.expr("parse_json(json)").alias("payload"))
    named = [r.layout for r in chat.layouts(df).orderBy("record").collect()]
    assert named == ["messages", "speakers", "instruction", "completion", "response", "question"] + ["unknown"] * 4
    turns = collections.defaultdict(list)
    for r in chat.turns(df).orderBy("conv_id", "turn").collect():
        turns[r.conv_id].append((r.role, r.text))
    assert turns[0] == [("user", "a"), ("assistant", "b")]
    assert turns[1] == [("system", "s"), ("user", "a"), ("assistant", "")]
    assert turns[2] == [("user", "do\n\nit"), ("assistant", "done")]
    assert turns[3] == [("user", "p"), ("assistant", "c")] and set(turns) == set(range(6))
    assert chat.formatted(chat.turns(df.limit(0))).collect() == []


def test_mixed_layouts(make):
    """Fields of a second layout don't make a conversation vanish: the first layout in order has it."""
    ask, reply = ("user", "a"), ("assistant", "b")
    both = '[{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]'
    records = [
        ('{"prompt": "x", "prompt_id": 7, "messages": %s}' % both, "messages", [ask, reply]),
        ('{"instruction": "a", "output": "b", "prompt": "x"}', "instruction", [ask, reply]),
        ('{"question": "a", "answer": "b", "input": "x"}', "question", [ask, reply]),
        ('{"messages": %s, "response": "c"}' % both, "messages and response", [ask, reply]),
        ('{"messages": [{"role": "user", "content": "a"}], "response": "b"}', "messages and response", [ask, reply]),
        ('{"system": "s", "messages": %s, "conversations": []}' % both, "messages", [("system", "s"), ask, reply]),
        ('{"prompt": "a", "completion": "b", "response": "c", "conversations": "none"}', "completion", [ask, reply]),
        ('{"prompt": "a", "messages": []}', "unknown", []),
        ('{"messages": "text", "response": "b"}', "unknown", []),
        (None, "unknown", []),
    ]
    df = make([(i, r[0], 1) for i, r in enumerate(records)], "record bigint, json string, layout int")
    df = df.select("record", F.expr("parse_json(json)").alias("payload"), "layout")
    got = {r.record: r.layout for r in chat.layouts(df.drop("layout")).collect()}
    assert got == {i: r[1] for i, r in enumerate(records)}
    turns = collections.defaultdict(list)
    for r in chat.turns(df).orderBy("conv_id", "turn").collect():
        turns[r.conv_id].append((r.role, r.text))
    assert [turns[i] for i in range(len(records))] == [r[2] for r in records]
    lost = {r.record: r.payload for r in chat.unmapped(df).collect()}
    assert lost == {7: '{"messages":[],"prompt":"a"}', 8: '{"messages":"text","response":"b"}', 9: None}
    assert chat.unmapped(df.limit(0)).collect() == []


def test_any_pair_of_layouts_has_the_first_ones_turns(make):
    """Brute force: every pair of layouts in one record, against each layout alone."""
    fields = {
        "messages": {"messages": [{"role": "user", "content": "m"}]},
        "speakers": {"conversations": [{"from": "human", "value": "v"}, {"from": "gpt", "value": "w"}]},
        "instruction": {"instruction": "i", "output": "o"},
        "completion": {"prompt": "p", "completion": "c"},
        "question": {"question": "q", "answer": "a"},
    }
    names = [n for n in chat.LAYOUTS if n in fields]
    pairs = [(x, y) for x in names for y in names]
    rows = [(i, json.dumps(fields[y] | fields[x])) for i, (x, y) in enumerate(pairs)]
    df = make(rows, "record bigint, json string").select("record", F.expr("parse_json(json)").alias("payload"))
    turns = collections.defaultdict(list)
    for r in chat.turns(df).orderBy("conv_id", "turn").collect():
        turns[r.conv_id].append((r.role, r.text))
    alone = {x: turns[i] for i, (x, y) in enumerate(pairs) if x == y}
    assert all(alone.values())
    assert {i: turns[i] for i in range(len(pairs))} == {i: alone[min(p, key=names.index)] for i, p in enumerate(pairs)}


def test_very_long_turns(make):
    long = "\\ ### </turn> é" * 200_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long), (2, 0, "assistant", "")]
    df = make(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.formatted(df)).collect()}
    assert [t.text for t in got[1].turns] == [long, long] and list(got[1].learned) == [long] and list(got[2].learned) == [""]


def test_long_conversations(make):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(3 * chat.STRETCH)]
    df = make(rows, "conv_id bigint, turn bigint, role string, text string")
    [r] = chat.read_back(chat.formatted(df)).collect()
    assert [t.text for t in r.turns] == [t for *_, t in rows] and list(r.learned) == [t for *_, t in rows if int(t[1:]) % 2]


# --- licences ---------------------------------------------------------------


def test_licences_of_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    known = {
        "gpl": "This work is licensed under the GNU General Public License, version 3.",
        "proprietary": "All rights reserved.",
        "cc-by-nc": "Licensed under CC BY-NC 4.0.",
        "mit": "Released under the MIT License.",
        "apache": "Licensed under the Apache License, Version 2.0.",
    }
    want = {
        r.doc_id: ",".join(sorted(k for k, t in known.items() if t in r.text)) for r in table(spark, sf_dir, "documents").collect()
    }
    got = {r.doc_id: r.families for r in queries.QUERIES["op9_licences"](spark, sf_dir).collect()}
    assert got == want and any(want.values())


def test_licences_of_odd_rows(make):
    texts = [
        "free text\nThis Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.\nmore",
        "The rights of all were reserved for the public under the license of 2.0 terms.",
        "Prose. " * 80 + "Released under the MIT License. " + "Prose. " * 80,
    ]
    rows = ODD + [(20 + i, t) for i, t in enumerate(texts)]
    got = licences.scan(make([(*r, "x") for r in rows], DOCS + ", families string")).collect()
    found = {r.doc_id: r.families for r in got}
    assert len(got) == len(rows) and (found[20], found[21], found[22]) == ("mpl", "", "mit")
    assert licences.scan(make([], DOCS)).collect() == []


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""


def test_licences_inside_lines_and_across_them(make):
    texts = {
        "The parser reads a file and builds a tree. Released under the MIT License. Please send patches to the list.": "mit",
        "A reader of files.\n\n" + MIT + "\n\nThe end of it.": "mit",
        "A reader of files. " + MIT.replace("\n", " ") + " The end of it.": "mit",
        "notes on\nThis program and the accompanying materials are made available under\nthe terms of the Eclipse Public License 2.0 "
        "which is available at\nhttps://www.eclipse.org/legal/epl-2.0/\nand more": "epl",
        "Permission to use, copy, modify, and/or distribute this software for any purpose\nwith or without fee is hereby granted, "
        "provided that the above copyright notice\nand this permission notice appear in all copies.": "isc",
        "She was granted a permission. The person had a copy of the software.\nThe conditions were free of charge.": "",
        "The notice was included in all the copies of the book. The library is public.": "",
    }
    df = make(list(enumerate(texts)), DOCS)
    assert {r.doc_id: r.families for r in licences.scan(df).collect()} == dict(enumerate(texts.values()))


def test_notices_that_overlap_are_one(make):
    text = "One.\nAll rights reserved.\nTwo of them went home by train that day.\nReleased under the\nMIT License.\n" + "Plain. " * 9 + "All rights reserved."
    scanner = licences.Scanner(make([(1, text)], DOCS))
    found = sorted((r.family, r.at) for r in scanner.found(make([(1, text), (1, text)], DOCS)).collect())
    assert [f for f, _ in found] == ["mit", "proprietary", "proprietary"]


def test_every_confirmed_paragraph_is_found(spark, make):
    """Brute force: all stretches, with and without cues, scored by the same model, confirmed in Python."""
    rng = random.Random(9)
    notices = [(f, t) for f, texts in licences.NOTICES.items() for t in texts]
    docs = []
    for i in range(40):
        lines = [rng.choice(licences.PLAIN) if rng.random() < 0.6 else rng.choice(notices)[1] for _ in range(4)]
        cut = " ".join(w for w in " ".join(lines).split(" ") if rng.random() < 0.93)
        docs.append((i, re.sub(" ", lambda m: "\n" if rng.random() < 0.08 else " ", cut)))
    df = make(docs, DOCS)
    scanner = licences.Scanner(df)
    for _, text in notices:
        own = sorted(set(re.findall(licences.WORD, text.lower())))
        for chosen in (scanner.cues, licences.cues({})):
            for _ in range(20):
                assert set(rng.sample(own, math.ceil(licences.CONFIRM * len(own)))) & set(chosen)
    every = []
    for i, text in docs:
        parts = [p for p in re.split(r"\n|(?<=[.!?])\s+", text) if p.strip(" ")]
        every += [
            (i, at, n, re.findall(licences.WORD, " ".join(parts[at : at + n]).lower()))
            for at in range(len(parts))
            for n in range(1, min(licences.JOINED, len(parts) - at) + 1)
        ]
    scored = scanner._scored(make(every, "doc_id bigint, at int, n int, w array<string>")).collect()
    want = set()
    for r in scored:
        own = set(r.w)
        for family, text in notices:
            template = set(re.findall(licences.WORD, text.lower()))
            shared = len(own & template)
            if family == r.family and r.probability >= scanner.bound:
                if shared >= licences.CONFIRM * len(template) and shared >= licences.RESEMBLES * len(own):
                    want.add((r.doc_id, r.at, r.n, family))
    assert {(r.doc_id, r.at, r.n, r.family) for r in scanner.confirmed(df).collect()} == want and len(want) > 40


def test_licence_models_come_from_all_pieces(make):
    """Counts of all pieces, not of a draw, though few may weigh in: brute force over distinct words."""
    notice = "Released under the MIT License."
    texts = [f"The {w} {k} files are free of the charge. He {w} it to the library in {k}." for w in ("use", "copy", "zzz") for k in range(40)]
    docs = make([(i, t) for i, t in enumerate([*texts, notice, *texts])], DOCS)
    scanner = licences.Scanner(docs, unknown=5)
    own = set(scanner.counter.vocabulary)
    want = collections.Counter()
    for t in texts + texts:
        for part in re.split(r"(?<=[.])\s+", t):
            w = re.findall(licences.WORD, part.lower())
            want[frozenset(own & {*w, *map(" ".join, zip(w, w[1:]))})] += 1
    assert {frozenset(r.grams): r.n for r in scanner._pieces(docs).collect()} == want and sum(want.values()) == 480
    counted = collections.Counter()
    for g, n in want.items():
        counted.update(dict.fromkeys([x for x in g if " " not in x], n))
    assert scanner.cues == licences.cues(counted)
    assert [r.doc_id for r in licences.scan(docs).where("n_notices > 0").collect()] == [len(texts)]


def test_licence_pieces_are_parsed_once(spark, monkeypatch):
    """What resembles a notice is told of counted pieces: no plan parses texts once for each template."""
    plans = []

    def noted(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return written(df, name)

    written = licences.written
    monkeypatch.setattr(licences, "written", noted)
    notice = "Released under the MIT License."
    docs = spark.createDataFrame([(i, f"The files are free of the charge. {notice}") for i in range(9)], DOCS)
    scanner = licences.Scanner(docs)
    plans.append(scanner._pieces(docs)._jdf.queryExecution().optimizedPlan().toString())
    assert all(plan.count("regexp_extract_all(") <= 1 for plan in plans)
    assert sum(plan.count("regexp_extract_all(") for plan in plans) == 2
    assert [r.n for r in scanner._pieces(docs).collect()] == [9]


# --- packing ----------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out.encode_special_tokens = True
    return lambda text: out.encode(text or "", add_special_tokens=False).ids + [packing.END]


def check_packed(rows, docs, tokenizer):
    pieces = collections.defaultdict(list)
    places = collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    want = collections.Counter()
    for key, text in docs:
        ids = tokenizer(text)
        for i, (start, length) in enumerate(packing.cuts(len(ids))):
            want[key, i, start, length, zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    for spans in places.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= packing.SEQUENCE
    return len(places)


def test_packing_of_documents(spark, tokenizer):
    sf_dir = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    rows = queries.QUERIES["op10_packing"](spark, sf_dir).collect()
    used = check_packed(rows, docs, tokenizer)
    assert used <= 1.01 * sum(r.length for r in rows) / packing.SEQUENCE + 1


def test_packing_of_odd_rows(make, tokenizer):
    rows = ODD + [(7, "<|endoftext|> hi"), (8, "a  b \n\n c d "), (9, "x" * 5000)]
    check_packed(packing.pack(make([(*r, 1) for r in rows], DOCS + ", piece int")).collect(), rows, tokenizer)
    assert packing.pack(make([], DOCS)).collect() == []


def test_added_tokens_in_texts(spark, make, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = lambda text: plain.encode(text or "", add_special_tokens=False).ids + [packing.END]
    texts = ["a <|endoftext|> hi", "<|endoftext|>", "<|endoftext|><|endoftext|> \n", "x  <|endoftext|>  y", "<|endoftext", None]
    rows = list(enumerate(texts))
    assert 50256 in ids(texts[0])
    make(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    check_packed(queries.QUERIES["op10_packing"](spark, str(tmp_path)).collect(), rows, ids)


def test_ids_are_kept(make, tokenizer):
    [r] = packing.pack(make([(1, "some words")], DOCS)).collect()
    assert np.frombuffer(r.ids, "<u4").tolist() == tokenizer("some words")


@pytest.mark.parametrize("seed", range(4))
def test_plans_place_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    counts = {int(n): int(rng.integers(1, 40)) for n in rng.choice(np.arange(1, 1025), 40 * seed + 1, replace=False)}
    plan = packing.Plan.best(counts)
    used = collections.defaultdict(list)
    for n, c in counts.items():
        sequence, offset = plan.places(np.full(c, n), np.arange(c))
        for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
            used[s].append((o, n))
    for spans in used.values():
        end = 0
        for offset, n in sorted(spans):
            assert offset == end
            end += n
        assert end <= packing.SEQUENCE


def test_configurations_are_optimal():
    """Halves and thirds: 6 sequences of 512+512, 4 of 341*3."""
    plan = packing.configurations([512, 341], np.array([12.0, 12.0]))
    assert sum(n for _, n in plan) == 10
