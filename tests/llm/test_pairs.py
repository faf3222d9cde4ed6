"""Fingerprints, decontamination and the Jaccard join against brute force, and odd rows."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendloom.llm import bottomk, fmindex, jaccard, queries, reconcile
from spendloom.llm.common import table

DOCS = "doc_id bigint, text string"
ODD = [
    (1, None),
    (2, ""),
    (3, "!!! ... ???"),
    (4, "one two"),
    (4, "one two"),
    (5, "One TWO"),
    (None, "one two three four five six seven"),
    (6, "one two three four five six seven"),
    (7, "word " * 30000),
    (8, " ".join(f"w{i}" for i in range(40000))),
    (9, "é" * 5 + " ünï ß"),
]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- fingerprints -----------------------------------------------------------


def test_sketches_recover_differences():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (0, 1, 3, 40, 700)]
    pairs = [(a, b) for a in sets for b in sets]
    pairs += [(sets[4], np.concatenate([sets[4][:600], sets[3]]))]
    gone, come = reconcile.differences([a for a, _ in pairs], [b for _, b in pairs])
    for (a, b), g, c in zip(pairs, gone, come, strict=True):
        assert set(g) == set(a.tolist()) - set(b.tolist())
        assert set(c) == set(b.tolist()) - set(a.tolist())


def test_likeness_is_jaccard():
    one, two = reconcile.digests("a. b. c. d"), reconcile.digests("a. b. c. e. f")
    assert reconcile.likeness([one, one, one[:0]], [two, one, one[:0]]).tolist() == [0.5, 1.0, 1.0]


def expected_edits(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    out = []
    for i, (key, text) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        k = len(text) // 3
        edited = text[: len(text) - k] + after[:k]
        a, b = set(reconcile.digests(text).tolist()), set(reconcile.digests(edited).tolist())
        near = len(a & b) / len(a | b) if a | b else 1.0
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), round(near, 9)))
    return collections.Counter(out)


@pytest.mark.parametrize("rows", [ODD, ODD[:1], [(None, "b. c"), (None, "a")], []])
def test_edits_of_odd_rows(make, rows):
    got = reconcile.neighbour_edits(make(rows, DOCS)).collect()
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9)) for r in got) == expected_edits(rows)


def test_edits_of_documents(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    got = queries.QUERIES["op1_fingerprints"](spark, sf_dir).collect()
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9)) for r in got) == expected_edits(rows)
    prints = collections.defaultdict(set)
    texts = dict(rows)
    for r in got:
        prints[texts[r.doc_id]].add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())


def test_version_differences(make):
    df = make([(1, "a. b. c", "a. b. d"), (2, None, "x")], "id int, before string, after string")
    rows = {r.id: r for r in reconcile.version_differences(df, "id", "before", "after").collect()}
    assert len(rows[1].gone) == len(rows[1].come) == 1 and rows[1].likeness == 0.5
    assert rows[2].likeness == 0.0 and rows[2].gone == [] and len(rows[2].come) == 1


# --- decontamination --------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def expected_leaks(docs, items, size=10):
    phrases = collections.defaultdict(set)
    for key, text in items:
        words = WORD.findall(lower(text))
        for i in range(max(1, len(words) - size + 1) if words else 0):
            phrases[tuple(words[i : i + size])].add(str(key))
    lengths = {len(p) for p in phrases}
    out = []
    for key, text in docs:
        words, found = WORD.findall(lower(text)), set()
        hit = [False] * len(words)
        for n in lengths:
            for i in range(len(words) - n + 1):
                if owners := phrases.get(tuple(words[i : i + n])):
                    found |= owners
                    hit[i : i + n] = [True] * n
        out.append((key, len(words), sum(hit), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    return collections.Counter(out)


def leak_rows(df):
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return collections.Counter(tuple(r) for r in df.select("doc_id", "n_words", "n_hit", digest).collect())


ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (2, "ONE two"), (3, None), (4, ""), (5, "w7 w8 w9"), (10, "one two")]


@pytest.mark.parametrize("block_chars", [1 << 20, 8])
def test_leaks_of_odd_rows(make, block_chars):
    found = fmindex.leaks(make(ODD, DOCS), make(ITEMS, "item_id bigint, text string"), block_chars=block_chars)
    assert leak_rows(found) == expected_leaks(ODD, ITEMS)


def test_blocks_of_phrases_give_the_same_spans(make):
    docs, items = make(ODD, DOCS), make(ITEMS, "item_id bigint, text string")
    one = {(r.doc_id, str(r.starts), str(r.ends)) for r in fmindex.leaks(docs, items).collect()}
    many = {(r.doc_id, str(r.starts), str(r.ends)) for r in fmindex.leaks(docs, items, block_chars=5).collect()}
    assert one == many


def test_leaks_of_empty_tables(make):
    none, docs = make([], "item_id bigint, text string"), make(ODD, DOCS)
    assert leak_rows(fmindex.leaks(docs, none)) == expected_leaks(ODD, [])
    assert fmindex.leaks(make([], DOCS), none).collect() == []


def test_leaks_of_documents(spark, sf_dir):
    docs = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    got = queries.QUERIES["op2_decontamination"](spark, sf_dir).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.n_hit, r.items_sha256) for r in got) == expected_leaks(docs, items)
    assert all(r.contaminated == (r.n_hit > 0) for r in got) and any(r.contaminated for r in got)


def test_removed_passages(make):
    docs = make([(1, "Hi, a b c D e. Bye", 18, "x"), (2, "clean", 5, "y"), (3, None, None, None)], DOCS + ", n_chars bigint, n_hit string")
    out = fmindex.remove_leaks(docs, make([(1, "a b c d e")], "item_id bigint, text string"))
    assert [tuple(r) for r in out.orderBy("doc_id").collect()] == [(1, "Hi, \n. Bye", 10, "x"), (2, "clean", 5, "y"), (3, None, None, None)]


# --- Jaccard join -----------------------------------------------------------


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def expected_groups(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    where = collections.defaultdict(list)
    for i, s in enumerate(sets):
        common = collections.Counter(j for g in s for j in where[g])
        for j, n in common.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
        for g in s:
            where[g].append(i)
    least = {}
    for i, (key, _) in enumerate(rows):
        r = root(i)
        if key is not None:
            least[r] = min(key, least.get(r, key))
    return collections.Counter((rows[i][0], len(s), least.get(root(i))) for i, s in enumerate(sets))


def group_rows(df):
    return collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def near_copies(n, words=60, edits=1, start=100):
    """A chain's worth of edits of one text, far more of them than a block of leaders reaches at once."""
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(words)]
    rows = []
    for i in range(n):
        text = list(base)
        for at in rng.integers(0, words, edits * (1 + i % 3)):
            text[at] = f"x{i}-{at}"
        rows.append((start + i, " ".join(text)))
    return rows


@pytest.mark.parametrize("rows", [ODD, [], [(1, None)], near_copies(80) + ODD])
def test_groups_of_odd_rows(make, rows):
    assert group_rows(jaccard.groups(make(rows, DOCS))) == expected_groups(rows)


def test_groups_that_share_passages(make):
    """Many unlike texts around one common passage, and chains of texts of which only neighbours link."""
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, " ".join([*(f"u{i}-{k}" for k in range(20 + i % 7)), passage])) for i in range(60)]
    chain = [f"c{i}" for i in range(200)]
    rows += [(1000 + i, " ".join(chain[2 * i : 2 * i + 60])) for i in range(40)]
    assert group_rows(jaccard.groups(make(rows, DOCS))) == expected_groups(rows)


def edited_copies(n, words=300, edits=5, seed=11):
    """Copies of one text with so many words changed at random places: few of them link, all of them meet."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = [f"b{k}" for k in range(words)]
        for k in rng.sample(range(words), edits + i % 6):
            text[k] = f"e{i}-{k}"
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("shingles_a_block", [None, 1 << 12])
def test_pairs_of_a_large_group_are_no_rows(make, monkeypatch, shingles_a_block):
    """Pairs written grow with a group of edited copies, not with its square; what is outside the group is paired as before."""
    rows = edited_copies(240) + [(1000 + k, t) for k, t in edited_copies(40, words=80, edits=1, seed=3)] + ODD
    passage = " ".join(f"b{k}" for k in range(60))
    rows += [(2000 + i, " ".join([*(f"u{i}-{k}" for k in range(10 + 2 * i)), passage])) for i in range(90)]
    written, kept = {}, jaccard.written

    def counted(df, name):
        out = kept(df, name)
        written[name] = max(written.get(name, 0), out.count())
        return out

    monkeypatch.setattr(jaccard, "written", counted)
    if shingles_a_block:
        monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", shingles_a_block)
    assert group_rows(jaccard.groups(make(rows, DOCS))) == expected_groups(rows)
    assert written["pairs"] < 16 * len(rows)


def test_groups_of_documents(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    assert group_rows(queries.QUERIES["op8_jaccard_join"](spark, sf_dir)) == expected_groups(rows)


def test_one_row_of_each_group_stays(make):
    rows = near_copies(10) + ODD + [(4, "one  two")]
    docs = make([(k, t, i) for i, (k, t) in enumerate(rows)], DOCS + ", node int")
    kept = jaccard.representatives(docs).collect()
    groups = expected_groups(rows)
    assert sum(1 for r in kept if shingles(r.text)) == len({c for _, n, c in groups if n})
    assert sum(1 for r in kept if not shingles(r.text)) == sum(1 for _, t in rows if not shingles(t))
    assert {r.doc_id for r in kept if shingles(r.text)} == {c for _, n, c in groups if n}


def test_apart_pairs_by_brute_force(make):
    rng = random.Random(7)
    rows = []
    for node in range(60):
        size, values = rng.choice((5, 40, 450, 700)), rng.sample(range(40), rng.randrange(1, 30))
        rows += [(v, node, size, len(values), node % 7) for v in values] + [(100 + node % 7, node, size, len(values), node % 7)]
    large = make(rows, "value bigint, node bigint, size bigint, in_large bigint, component bigint")
    of = {n: ({v for v, m, *_ in rows if m == n}, s, c) for _, n, s, _, c in rows}
    want = set()
    for a, b in itertools.combinations(sorted(of), 2):
        (x, p, c), (y, q, d) = of[a], of[b]
        if c == d or 100 * min(p, q) < bottomk.PERCENT * max(p, q):
            continue
        asked = -(-bottomk.PERCENT * (p + q) // (100 + bottomk.PERCENT)) if max(p, q) <= bottomk.K else bottomk.SHARED
        unlisted = max(bottomk.needed(s) - 1 - (bottomk.MORE if s >= bottomk.LONG else 0) for s in (p, q))
        if x & y and len(x & y) >= max(asked - unlisted, 1):
            want.add((a, b, p, q))
    found = bottomk._apart_pairs(large)
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 20
    # Sets are met once a pair, after the counts.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_intersect(") == 1


def test_apart_pairs_that_share_most_lists(make):
    """Pairs that meet in dozens of lists come once; they are told apart by compiled code, and in short lists first."""
    size, nodes = 300, 24
    # Lists 0 to 59 have all nodes, 60 to 71 two each.
    of = {n: {*range(60 - n % 2), 60 + n // 2} for n in range(nodes)}
    rows = [(v, n, size, len(values), n) for n, values in of.items() for v in values]
    found = bottomk._apart_pairs(make(rows, "value bigint, node bigint, size bigint, in_large bigint, component bigint"))
    least = -(-2 * size * bottomk.PERCENT // (100 + bottomk.PERCENT)) - bottomk.needed(size) + 1
    want = [(a, b) for a, b in itertools.combinations(range(nodes), 2) if len(of[a] & of[b]) >= least]
    assert sorted((r.a, r.b) for r in found.collect()) == want and len(want) == nodes * (nodes - 1) // 2
    condition = found._jdf.queryExecution().optimizedPlan().toString()
    assert "exists(" not in condition and condition.count("arrays_overlap(") == 1
    assert "members" in condition


def test_list_entries_are_shuffled_once(make):
    rng = random.Random(3)
    rows = [(rng.randrange(60), rng.randrange(40), 7) for _ in range(150)]
    rows += rows[:9]
    found = bottomk._with_members(make(rows, "value bigint, node bigint, size bigint"))
    of = {v: [r[1] for r in rows if r[0] == v] for v, *_ in rows}
    want = {(v, n, s, len(of[v])) for v, n, s in rows if len(set(of[v])) > 1}
    assert sorted(map(tuple, found.collect())) == sorted(want) and 0 < len(want) < len(rows)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2  # the final plan repeats the first
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_only_sets_of_pairs_are_joined(make):
    sets = make([(n - 500, bytes(8 * (1 + n % 5))) for n in range(1000)], "node bigint, packed binary")
    pairs = make([(-500, 499), (-500, 7), (7, 499)] * 5, "a bigint, b bigint")
    found = [tuple(r) for r in bottomk.among(sets, pairs).collect()]
    have = dict(map(tuple, sets.collect()))
    assert {-500, 7, 499} <= {n for n, _ in found} and all(have[n] == p for n, p in found) and len(found) < 30
    assert bottomk.among(sets, pairs.limit(0)).isEmpty()
    # A node of many pairs is one row of the filter's input.
    wanted = bottomk._nodes_of(pairs).distinct()
    assert wanted.count() == 3


def near_sets(families=3, nodes=40, size=120):
    """Packed sets of families, in which most pairs are close and some of them link; one family's are beyond a sketch."""
    rng, sets = np.random.default_rng(11), {}
    for f in range(families):
        n = size if f else 5 * bottomk.K
        base = rng.integers(0, 1 << 63, n).astype(np.uint64)
        for i in range(nodes):
            own = base.copy()
            at = rng.integers(0, n, n // 20 + i * n // 400)
            own[at] = rng.integers(0, 1 << 63, len(at)).astype(np.uint64)
            sets[1000 * f + i - 500] = np.unique(own)
    return sets


@pytest.mark.parametrize("block", [None, 500])
def test_pairs_of_near_copies_meet_in_blocks(make, monkeypatch, block):
    if block:
        monkeypatch.setattr(bottomk, "BLOCK", block)
    sets = near_sets()
    pairs = [(a, b, len(sets[a]), len(sets[b])) for a, b in itertools.combinations(sorted(sets), 2) if a // 500 == b // 500]
    frame = make(pairs, "a bigint, b bigint, size_a bigint, size_b bigint")
    stored = make([(n, s.tobytes()) for n, s in sets.items()] + [(9999, bytes(8))], "node bigint, packed binary")
    found = [tuple(r) for r in bottomk.verified_in_blocks(frame, stored).collect()]
    want = {(a, b) for a, b, p, q in pairs if 180 * len(np.intersect1d(sets[a], sets[b])) >= 80 * (p + q)}
    assert len(found) == len(set(found)) and set(found) == want and 0 < len(want) < len(pairs)
    blocks = {tuple(r) for r in bottomk.blocked(frame).collect()}
    met = {(n, frozenset(r[2:])) for r in blocks for n in r[:2]}
    assert len(blocks) == len(pairs)
    # Pairs bring a set 39 times to its family; blocks as often as the family has blocks.
    if block is None:
        assert len({b for r in blocks for b in r[2:]}) < 12 and len(met) < 4 * len(sets)
    else:
        assert len({b for r in blocks for b in r[2:]}) > 40


def test_no_pairs_meet_in_blocks(make):
    none = make([], "a bigint, b bigint, size_a bigint, size_b bigint")
    assert bottomk.verified_in_blocks(none, make([], "node bigint, packed binary")).collect() == []


def test_entries_no_partner_can_reach_are_left_out(make):
    def least(p, q):
        asked = -(-bottomk.PERCENT * (p + q) // (100 + bottomk.PERCENT)) if max(p, q) <= bottomk.K else bottomk.SHARED
        return max(asked - max(bottomk.needed(s) - 1 - (bottomk.MORE if s >= bottomk.LONG else 0) for s in (p, q)), 1)

    rng, rows = random.Random(2), []
    for size in range(1, 900, 3):
        for spread in (0, 5, 40, 900):
            rows.append((size, max(1, size - rng.randint(0, spread)), size + rng.randint(0, spread)))
    found = make(rows, "size bigint, shortest bigint, longest bigint").selectExpr("*", f"{bottomk._LEAST_OF_LIST} AS t").collect()
    for size, shortest, longest, t in found:
        partners = range(max(shortest, -(-size * bottomk.PERCENT // 100)), min(longest, size * 100 // bottomk.PERCENT) + 1)
        assert t <= min(least(size, q) for q in partners)
    assert all(t == least(size, size) for size, shortest, longest, t in found if shortest == longest and least(size, size) > 1)
    # Of lists that nodes of one size share, the last entries make no pair.
    large = [(v, n, 300, 40, n) for n in range(12) for v in range(40)]
    plan = bottomk._apart_pairs(make(large, "value bigint, node bigint, size bigint, in_large bigint, component bigint"))
    assert plan.count() == 66 and "longest" in plan._jdf.queryExecution().optimizedPlan().toString()
