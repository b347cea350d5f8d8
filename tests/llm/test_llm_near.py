"""Near duplicates, fingerprints and components against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from relaydesk.llm import cap_dedup, common, fingerprints, line_dedup, ngram_join
from relaydesk.llm.components import components


def joined(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("broadcast", [400_000, 0])
def test_components(spark, monkeypatch, broadcast):
    monkeypatch.setattr(common, "BROADCAST_ROWS", broadcast)
    draw = random.Random(4)
    pairs = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(200)] + [(-5, 7000), (8, 8)]
    pairs += [(draw.randint(2000, 2400), draw.randint(2000, 2400)) for _ in range(250)]
    rows = [*pairs, *pairs[:20], (None, 3), (3, None)]
    out = components(spark.createDataFrame(rows, "a long, b long")).collect()
    real = [(a, b) for a, b in pairs if a != b]
    assert {r.node: r.component for r in out} == joined(real, {n for p in real for n in p})
    assert len(out) == len({r.node for r in out})
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_texts(seed, groups=12, words=60):
    """Copies of some texts with more and more words changed."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7)))
    passage = " ".join(word() for _ in range(40))
    out = []
    for g in range(groups):
        base = [word() for _ in range(draw.randint(1, words))]
        for k in range(draw.randint(1, 9)):
            own = [word() if draw.random() < 0.02 * (k % 5) else w for w in base]
            out.append(" ".join(own) + (f" {passage}" if g % 3 == 0 else ""))
    return out


WORD = re.compile(rb"[^\x20\x09-\x0d]+")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingles(text):
    w = WORD.findall((text or "").encode().translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


@pytest.mark.parametrize("block,broadcast", [(512, 400_000), (3, 0)])
def test_ngram_join_is_exact(spark, monkeypatch, block, broadcast):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(common, "BROADCAST_ROWS", broadcast)
    texts = [None, "", " \t\n", "one", "ONE", "one two", "a b c d e", "A b\tc d  e", "É b c d e", "é b c d e", "w " * 20_000, *near_texts(1)]
    rows = [(3 * i - 5, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_shingles string").repartition(3)
    out = {r.doc_id: r for r in ngram_join.near_classes(docs).collect()}
    sets = {key: shingles(t) for key, t, _ in rows}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    expected = joined(links, sets)
    assert {k: (r.n_shingles, r.component_id) for k, r in out.items()} == {k: (len(s), expected[k]) for k, s in sets.items()}
    assert len(set(expected.values())) < len(expected) - 20


def test_ngram_join_of_odd_rows(spark):
    text = "some words that make a line of text"
    docs = spark.createDataFrame([(None, text), (4, text), (4, text), (4, "other"), (9, text)], "doc_id long, text string")
    out = sorted(((r.doc_id, r.component_id) for r in ngram_join.near_classes(docs).collect()), key=str)
    assert out == [(4, 4), (4, 4), (4, 4), (9, 4), (None, 4)]
    assert ngram_join.near_classes(docs.limit(0)).count() == 0


def test_index_finds_what_brute_force_finds():
    draw = random.Random(8)
    base = [draw.getrandbits(64) for _ in range(120)]
    sets = [np.unique(np.array([x for x in base if draw.random() > 0.12] + [draw.getrandbits(64) for _ in range(k % 15)], np.uint64)) for k in range(60)]
    index = ngram_join.Index(sets)
    for i, query in enumerate(sets):
        expected = [j for j, s in enumerate(sets) if 100 * len(np.intersect1d(query, s)) >= 75 * len(np.union1d(query, s))]
        assert index.linked(query).tolist() in ([expected] if len(expected) > 1 else [[], [i]])


def test_signatures_never_part_linked_sets():
    draw = np.random.default_rng(3)
    for n in (1, 5, 40, 300, 2000):
        base = ngram_join._mix(draw.integers(1, 2**63, n).astype(np.uint64))
        sets = [np.unique(np.append(base[draw.random(n) > k / 40], draw.integers(1, 2**63, n * k // 80 + 1).astype(np.uint64))) for k in range(12)]
        sizes = np.array([len(s) for s in sets])
        marks = ngram_join._folded([ngram_join.signature(s).tobytes() for s in sets])
        told = 0
        for i, query in enumerate(sets):
            near = ngram_join._plausible(75, marks[i], marks, sizes[i], sizes)
            linked = np.array([100 * len(np.intersect1d(query, s)) >= 75 * len(np.union1d(query, s)) for s in sets])
            assert near[linked].all()
            told += (~near).sum()
        assert told > 0 or n < 40


def test_whole_sets_go_only_where_they_may_be_linked(spark, monkeypatch):
    sent, with_sets = [], ngram_join._with_sets

    def counted(groups, sets):
        if "set" in sets.columns:
            sent.append(groups.count())
        return with_sets(groups, sets)

    monkeypatch.setattr(ngram_join, "_with_sets", counted)
    draw = random.Random(5)
    base = [f"word{i}" for i in range(200)]
    texts = [" ".join(f"own{k}x{i}" if i in own else w for i, w in enumerate(base)) for k in range(12) for own in [draw.sample(range(200), 8)]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(2)
    sets = [shingles(t) for t in texts]
    assert all(100 * len(a & b) < 75 * len(a | b) for a in sets for b in sets if a is not b)
    assert all(r.doc_id == r.component_id for r in ngram_join.near_classes(docs).collect())
    assert sum(sent) <= 2


LINE_TEXTS = [
    None, "", "\n\n", "one line only", " one line only\r", "In.\nIn.\nkeep this", "In.",
    "\n".join(f"sentence number {i} stands in this document as it does in no other" for i in range(30)),
    "中文没有空格的一行文字在这里重复出现很多次", "中文没有空格的一行文字在这里重复出现很多遍", "日本語の別の文章です",
]


def test_line_dedup(spark):
    draw = random.Random(2)
    line = " ".join("".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(50))
    near = line.replace(line.split()[20], "changed")
    far = " ".join(w if i % 3 else "z" * (i + 1) for i, w in enumerate(line.split()))
    texts = [*LINE_TEXTS, f"first\n{line}", f"{near}\nlast", f"before\n{far}\nafter", f"{line}\n{line}"]
    docs = spark.createDataFrame([(10 + i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_lines string").repartition(3)
    out = {r.doc_id - 10: r for r in line_dedup.dedup_lines(docs).collect()}
    assert [out[i].text for i in range(4)] == [None, "", "\n\n", "one line only"]
    assert [(out[i].n_lines, out[i].n_dropped) for i in range(7)] == [(0, 0), (0, 0), (0, 0), (1, 0), (1, 1), (3, 1), (1, 1)]
    assert out[5].text == "In.\nkeep this" and out[4].text == out[6].text == ""
    assert (out[8].n_dropped, out[9].n_dropped, out[10].n_dropped) == (0, 1, 0)
    at = len(LINE_TEXTS)
    assert out[at].text == f"first\n{line}" and out[at + 1].text == "last"
    assert out[at + 2].n_dropped == 0 and out[at + 3].text == "" and out[at + 3].n_dropped == 2


def test_line_dedup_keeps_one_line_of_every_component(spark):
    """Against brute force over the same shingles: what is linked exactly, and what bands find of it."""
    draw = random.Random(9)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7)))
    lines = []
    for _ in range(25):
        base = [word() for _ in range(draw.randint(1, 60))]
        lines += [" ".join(word() if draw.random() < 0.01 * (k % 6) else w for w in base) for k in range(draw.randint(1, 12))]

    def cut(text):
        words = text.split(" ")
        pieces = words if len(text) <= line_dedup.LONG_WORD * len(words) else list(text)
        return {(p, pieces[i + 1][: line_dedup.AHEAD]) for i, p in enumerate(pieces[:-1])} or {(pieces[0],)}

    sets = [cut(x) for x in lines]
    links = [(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if len(sets[a] & sets[b]) >= 0.75 * len(sets[a] | sets[b])]
    parts = joined(links, range(len(sets)))
    out = line_dedup.dedup_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)).collect()
    kept = {r.doc_id for r in out if not r.n_dropped}
    exact = set(parts.values())
    assert exact <= kept  # nothing is dropped that nothing is like
    assert len(kept) <= len(exact) + 0.02 * len(lines)


def word_cut(text):
    words = text.split(" ")
    pieces = words if len(text) <= line_dedup.LONG_WORD * len(words) else list(text)
    return {(p, pieces[i + 1][: line_dedup.AHEAD]) for i, p in enumerate(pieces[:-1])} or {(pieces[0],)}


def kept_and_exact(spark, lines, cut, **how):
    """Lines that the operator keeps, and those that brute force keeps."""
    sets = [cut(x) for x in lines]
    links = [(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    kept = {r.doc_id for r in line_dedup.dedup_lines(docs, **how).collect() if not r.n_dropped}
    return kept, set(joined(links, range(len(sets))).values())


def short_lines(seed, least, most):
    """Lines of a few words and copies of them with a letter changed or the end cut."""
    draw, out = random.Random(seed), []
    for _ in range(60):
        line = " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 9))) for _ in range(draw.randint(least, most)))
        out.append(line)
        for _ in range(draw.randint(0, 4)):
            at = draw.randrange(len(line))
            out.append(draw.choice([line[:at] + "z" + line[at + 1 :], line[:-1] + "z", line[:-1]]).strip())
    return out


def test_short_lines_are_compared(spark):
    kept, exact = kept_and_exact(spark, [*short_lines(3, 2, 8), "Read more below", "Read more belong"], word_cut)
    assert kept == exact


@pytest.mark.parametrize("n", [3, 7, 8, 10, 14, 20, 28, 35, 36, 47, 60, 100, 400])
def test_recall_of_line_keys(n):
    """Of pairs at the least similarity, whose sets have ``n`` shingles."""
    draw = np.random.default_rng(n)
    union = max(u for u in range(n, 2 * n + 1) if 4 * (2 * n - u) >= 3 * u)
    found = 0
    for _ in range(8):
        rows = draw.integers(0, 2**64, (250, union), np.uint64)
        a = line_dedup.line_keys(list(rows[:, :n]), 75.0)
        b = line_dedup.line_keys(list(rows[:, union - n :]), 75.0)
        found += sum(len(np.intersect1d(x, y)) > 0 for x, y in zip(a, b))
    assert found >= 0.99 * 2000


@pytest.mark.parametrize("block,broadcast", [(512, 400_000), (2, 0)])
def test_a_crowded_key_is_searched_in_full(spark, monkeypatch, block, broadcast):
    """Lines that are alike but unlike the first and the longest line of the only key they share."""
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    monkeypatch.setattr(common, "BROADCAST_ROWS", broadcast)
    sets = {c: set(range(100 * c, 100 * c + 40)) for c in range(1, 9)} | {9: set(range(5000, 5400))}
    sets |= {10: sets[3] ^ {300}, 11: sets[7] ^ {700, 1}, 12: sets[7] ^ {700, 1, 701}, -4: set(range(6000, 6040))}
    rows = spark.createDataFrame([(c, [77] if c > 0 else [77, 78]) for c in sets], "class long, keys array<long>")
    content = spark.createDataFrame([(c, sorted(s)) for c, s in sets.items()], "class long, content array<long>")
    out = {(r.a, r.b) for r in line_dedup.links(rows, lambda wanted: content, None, 75.0).collect()}
    parts = joined(out, sets)
    assert parts == {c: {10: 3, 11: 7, 12: 7}.get(c, c) for c in sets}


@pytest.mark.parametrize("words", [(2, 8), (9, 14), (15, 40)])
def test_line_dedup_by_every_character(spark, words):
    k = line_dedup.CHARACTERS
    cut = lambda text: {text[i : i + k] for i in range(max(1, len(text) - k + 1))}
    lines = short_lines(words[0], *words)
    kept, exact = kept_and_exact(spark, [*lines, "abc", "abd", "中文没有空格的一行文字", "中文没有空格的一行文孛"], cut, characters=k)
    assert kept == exact


def test_keys_are_counted_in_slices_and_tables_go(spark, monkeypatch, tmp_path):
    """Only what the result still reads stays in the shared folder."""
    monkeypatch.setattr(line_dedup, "SLICED", 10)
    made = []
    monkeypatch.setattr(common, "fresh_dir", lambda _, name: made.append(name) or f"{tmp_path}/{name}-{len(made)}")
    k = line_dedup.CHARACTERS
    cut = lambda text: {text[i : i + k] for i in range(max(1, len(text) - k + 1))}
    kept, exact = kept_and_exact(spark, short_lines(8, 5, 30), cut, characters=k)
    assert kept == exact
    assert made.count("shared") == line_dedup.SLICES
    large = {"keyed", "lines", "shared", "members", "contents", "groups", "placed"}
    assert not large & {p.name.rpartition("-")[0] for p in tmp_path.iterdir()}


def test_signatures_lose_no_link():
    draw = random.Random(4)
    sets = []
    for n in (1, 2, 7, 40, 300, 3000):
        base = [draw.getrandbits(64) for _ in range(n)]
        for share in (0.0, 0.05, 0.13, 0.15, 0.3):
            own = [draw.getrandbits(64) if draw.random() < share else h for h in base]
            sets.append(np.array([*own, own[0]], np.uint64))
    made, others = line_dedup.Sets(sets), np.arange(len(sets))
    for i, s in enumerate(sets):
        exact = [j for j, t in enumerate(sets) if 100 * len({*s} & {*t}) >= 75 * len({*s} | {*t})]
        assert made.linked(i, others, 75.0).tolist() == exact


def test_only_keys_of_many_rows_are_repeated(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    made, write = [], common.written
    monkeypatch.setattr(common, "written", lambda df, name: made.append(write(df, name)) or made[-1])
    rows = spark.createDataFrame([(1 if i < 50 else i, i) for i in range(60)] + [(None, 60)], "k long, v long")
    dim = spark.createDataFrame([(1, "a"), (55, "b"), (77, "c"), (None, "d")], "k long, w string")
    out = common.spread_join(rows, dim, "k", common.F.col("v"), per_task=10)
    assert sorted((r.k, r.v, r.w) for r in out.collect()) == [(1, i, "a") for i in range(50)] + [(55, 55, "b")]
    assert [r.k for r in made[0].collect()] == [1]


def test_query_compares_every_character(spark, tmp_path):
    from relaydesk.llm import queries

    line = "these twelve words make one ordinary line with a typo further inside"
    texts = [line, line.replace("ordinary", "orxinary"), "another line"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.doc_id: r.n_dropped for r in queries.op10_line_dedup(spark, str(tmp_path)).collect()} == {0: 0, 1: 1, 2: 0}


def test_only_keys_that_may_be_shared_are_shuffled_again(spark, monkeypatch):
    sent, meet_counted = [], common.meet_counted

    def counted(rows, *more):
        sent.append(rows.count())
        return meet_counted(rows, *more)

    monkeypatch.setattr(line_dedup, "meet_counted", counted)
    draw = random.Random(6)
    lines = [" ".join(str(draw.getrandbits(40)) for _ in range(12)) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*lines, lines[0] + "1"])], "doc_id long, text string")
    out = {r.doc_id: r.n_dropped for r in line_dedup.dedup_lines(docs, characters=5).collect()}
    assert out[60] == 1 and sum(out.values()) == 1
    assert len(sent) == 1 and sent[0] <= 60  # of 25 keys a line


@pytest.mark.parametrize("broadcast", [400_000, 0])
def test_crowded_keys_are_dealt_out(spark, monkeypatch, broadcast):
    monkeypatch.setattr(common, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(common, "CROWDED", 10)
    rows = spark.createDataFrame([(1 if i < 50 else i, i) for i in range(60)], "k long, v long")
    dim = spark.createDataFrame([(1, "a", 50), (55, "b", 1), (77, "c", 90)], "k long, w string, _times long")
    out = common.meet_counted(rows, dim, "k", common.F.col("v"), "_times")
    assert out.columns == ["k", "v", "w"]
    assert sorted(map(tuple, out.collect())) == [(1, i, "a") for i in range(50)] + [(55, 55, "b")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_what_only_seems_small_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    rows = spark.range(40).selectExpr("id % 7 AS k", "id AS v")
    dim = common.written(spark.range(5).selectExpr("id AS k", "id + 1 AS w", "3 AS _times"), "dim")
    spread = common.F.col("v")
    # what is counted, the crowded keys, may be broadcast
    for made, counted in (
        (common.salted(rows, dim, "k", spread), 0),
        (common.meet(rows, dim, "k", spread), 0),
        (common.meet_counted(rows, dim, "k", spread, "_times"), 1),
        (common.spread_join(rows, dim, "k", spread), 2),
    ):
        assert plan(made).count("BroadcastHashJoin") == counted
        assert sorted((r.v, r.w) for r in made.where("w is not null").collect()) == [(i, i % 7 + 1) for i in range(40) if i % 7 < 5]


def test_components_are_sent_once(spark):
    docs = spark.createDataFrame([(i, f"some words that make a line of text {i // 2}") for i in range(8)], "doc_id long, text string")
    near = ngram_join.near_classes(docs)
    assert "explode" not in plan(near)
    assert sorted((r.doc_id, r.component_id) for r in near.collect()) == [(i, i - i % 2) for i in range(8)]


def test_wanted_lines_and_judged_rows_are_shuffled(spark, monkeypatch):
    plans, write = {}, line_dedup.written
    monkeypatch.setattr(line_dedup, "written", lambda df, name: plans.setdefault(name, plan(df)) and write(df, name))
    docs = spark.createDataFrame([(1, "a line of text\nother"), (2, "a line of text")], "doc_id long, text string")
    out = line_dedup.dedup_lines(docs, characters=5)
    assert sorted((r.doc_id, r.n_dropped) for r in out.collect()) == [(1, 0), (2, 1)]
    near = spark.createDataFrame([(1, "one line of some text"), (2, "one line of some texts")], "doc_id long, text string")
    assert sum(r.n_dropped for r in line_dedup.dedup_lines(near, characters=5).collect()) == 1
    # first places are counted before they are broadcast
    for told, counted in ((plans["contents"], 0), (plans["dropped"], 1), (plan(out), 0)):
        assert told.count("BroadcastHashJoin") == counted


def test_line_dedup_of_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a line\nb"), (7, "a line"), (7, "a line"), (8, "a line")], "doc_id long, text string")
    out = sorted(((r.doc_id, r.text, r.n_dropped) for r in line_dedup.dedup_lines(docs).collect()), key=str)
    assert out == [(7, "", 1), (7, "", 1), (8, "", 1), (None, "a line\nb", 0)]
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_fingerprints(spark):
    texts = {3: "abc def", 1: "one two three four", 9: None, 5: "äöü ß", 7: "one two three four", 8: "w " * 30_000}
    docs = spark.createDataFrame([(k, t, "x") for k, t in texts.items()] + [(None, "y", "x"), (3, "zzz", "x")], "doc_id long, text string, n_chars string")
    out = {r.doc_id: r for r in fingerprints.edit_report(docs).collect()}
    order = sorted(texts)
    for i, key in enumerate(order):
        text, after = texts[key] or "", texts[order[(i + 1) % len(order)]] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert out[key].n_chars == len(text)
        assert out[key].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= out[key].near_edited <= 1 and 0 <= out[key].near_next <= 1
    assert out[1].fingerprint == out[7].fingerprint and len(out[1].fingerprint) == 8 * fingerprints.SAMPLES
    assert out[9].fingerprint == "" and out[9].near_edited == 1 and set(out) == set(texts)
    single = fingerprints.edit_report(docs.where("doc_id = 1")).first()
    assert single.near_next == 1 and fingerprints.edit_report(docs.limit(0)).count() == 0


def test_collision_rate_is_the_generalised_jaccard_similarity(spark):
    draw = random.Random(6)
    rows, expected = [], []
    for i in range(150):
        words = [f"w{draw.randint(0, 40)}" for _ in range(60)]
        other = [w if draw.random() < i / 150 else f"v{draw.randint(0, 40)}" for w in words]
        a, b = Counter(words), Counter(other)
        expected.append(sum((a & b).values()) / sum((a | b).values()))
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    out = fingerprints.fingerprint(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    samples = {r.doc_id: r.samples for r in out}
    got = [np.mean([x == y for x, y in zip(samples[2 * i], samples[2 * i + 1])]) for i in range(150)]
    assert abs(np.mean(got) - np.mean(expected)) < 0.02
    assert np.sqrt(np.mean((np.array(got) - expected) ** 2)) < 1.3 * np.sqrt(0.25 / fingerprints.SAMPLES)


@pytest.mark.parametrize("block", [1024, 7])
def test_near_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(cap_dedup, "BLOCK", block)
    draw = np.random.default_rng(0)
    vectors = []
    for i in range(40):
        centre = draw.standard_normal(64)
        vectors += [centre + draw.standard_normal(64) * draw.uniform(0, 0.4) for _ in range(1 + i % 9)]
    vectors += [vectors[0]] * 30 + [vectors[5] * 2]
    x = np.array(vectors, np.float32)
    odd = [None, [0.0] * 64, [float("nan")] * 64, [float("inf")] * 64, [None] * 64, []]
    rows = [(3 * i, v.tolist(), 1) for i, v in enumerate(x)] + [(9001 + i, v, 1) for i, v in enumerate(odd)] + [(None, x[0].tolist(), 1)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>, kept int").repartition(3)
    out = {r.vec_id: r for r in cap_dedup.near_vectors(docs).collect()}
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    found = np.array([out[3 * i].n_links for i in range(len(x))])
    assert (found <= near.sum(axis=1)).all() and found.sum() >= 0.99 * near.sum()
    links = [(3 * a, 3 * b) for a, b in zip(*np.nonzero(np.triu(near)))]
    expected = joined(links, [3 * i for i in range(len(x))])
    assert np.mean([out[k].component_id == c for k, c in expected.items()]) > 0.98
    assert all((out[9001 + i].n_links, out[9001 + i].component_id, out[9001 + i].kept) == (0, 9001 + i, True) for i in range(len(odd)))
    assert out[None].n_links == 0 and not out[None].kept
    assert cap_dedup.near_vectors(docs.limit(0)).count() == 0


def test_near_vectors_of_other_types_and_lengths(spark):
    rows = [(1, [1, 2]), (2, [2, 4]), (3, [1, 2, 0]), (4, [3, -9])]
    out = {r.vec_id: r.component_id for r in cap_dedup.near_vectors(spark.createDataFrame(rows, "vec_id int, embedding array<int>")).collect()}
    assert out == {1: 1, 2: 1, 3: 3, 4: 4}


def test_caps_are_all_directions_that_reach_the_threshold():
    code = cap_dedup.CapCode(16, tables=1, codes=12, threshold=1.5)
    draw = np.random.default_rng(1)
    x = draw.standard_normal((20, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rotation, books = code.tables[0]
    for own, found in zip(x @ rotation, code.decode(x)):
        scores = (books[0] @ own[:8])[:, None] + (books[1] @ own[8:])[None, :]
        assert found.tolist() == np.flatnonzero(scores.ravel() >= code.least).tolist()


@pytest.mark.parametrize("cosine,least", [(0.9, 0.985), (0.97, 0.995)])
def test_recall_of_caps(cosine, least):
    draw = np.random.default_rng(3)
    x = draw.standard_normal((1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = draw.standard_normal(x.shape)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    code = cap_dedup.CapCode(64)
    other = code.decode(cosine * x + np.sqrt(1 - cosine**2) * y)
    assert np.mean([len(np.intersect1d(a, b)) > 0 for a, b in zip(code.decode(x), other)]) > least
