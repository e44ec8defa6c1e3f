"""Exact, SimHash and suffix-array duplicates, toxicity, urls and the pipeline."""

import hashlib
import random
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vereda.llm import exact, queries, simhash, suffixes, toxicity, urls
from vereda.llm.components import components
from vereda.session import park

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, component_id string"


def frame_of(spark, rows):
    return spark.createDataFrame([(doc, text, "l", None, 1, "mine") for doc, text in rows], DOCS)


# Exact


def test_exact_groups(spark):
    rows = [(4, "a b"), (2, "ab"), (1, "a  b\n"), (7, "a\tb "), (3, None), (5, ""), (6, " \n"), (8, "other"),
            (9, "ab\u00a0"), (2, "ab"), (None, "x"), (None, "x"), (10, "x")]
    got = exact.exact_groups(frame_of(spark, rows), hash_all=True).collect()
    assert len(got) == len(rows)
    groups = defaultdict(list)
    for doc, text in rows:
        groups["".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")].append((doc, text or ""))
    for plain, members in groups.items():
        digest = hashlib.sha256(plain.encode()).hexdigest()
        mine = [r for r in got if r.text_sha256 == digest]
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        assert {r.group_size for r in mine} == {len(members)} and {r.keep_id for r in mine} == {best[0]}
        assert sum(r.kept for r in mine) == 1
    kept = exact.keep_exact(frame_of(spark, rows))
    assert kept.count() == len(groups) and kept.columns == frame_of(spark, rows).columns
    assert exact.exact_groups(frame_of(spark, [])).count() == 0


# SimHash


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, radius):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(x) for x in range(len(values))]


def test_fingerprints():
    for text in ["", " \n", "One", "a b c", "A b C d e f É", "the cat sat on the mat " * 50]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_link_block():
    random.seed(3)
    base = [random.getrandbits(64) for _ in range(30)]
    values, groups = [], []
    for at, value in enumerate(base * 4):
        for _ in range(random.randrange(4)):
            value ^= 1 << random.randrange(64)
        values.append(value)
        groups.append(at % 3)
    order = sorted(range(len(values)), key=lambda i: groups[i])
    values, groups = [values[i] for i in order], [groups[i] for i in order]
    edges = simhash.link_block(np.array(values, np.uint64), np.array(groups), 4)
    assert all(bin(values[a] ^ values[b]).count("1") <= 4 and groups[a] == groups[b] for a, b in edges)
    for group in range(3):
        inside = [i for i in range(len(values)) if groups[i] == group]
        want = plain_components([values[i] for i in inside], 4)
        root = {i: i for i in inside}
        for a, b in edges:
            if groups[a] == group:
                old, new = root[a], root[b]
                root = {k: new if v == old else v for k, v in root.items()}
        same = lambda labels: [[x == y for y in labels] for x in labels]
        assert same([root[i] for i in inside]) == same(want)


@pytest.mark.parametrize("tile", [4096, 3])
def test_near_groups(spark, tile):
    random.seed(5)
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", "\n", "one two"]
    for _ in range(12):
        body = random.choices(words, k=120)
        for _ in range(5):
            copy = list(body)
            for _ in range(random.randrange(3)):
                copy[random.randrange(len(copy))] = random.choice(words)
            texts.append(" ".join(copy))
    rows = [(1000 - 3 * at, text) for at, text in enumerate(texts)] + [(1000, None), (None, "one two")]
    got = simhash.near_groups(frame_of(spark, rows), tile=tile).collect()
    values = [plain_fingerprint(text or "") for _, text in rows]
    labels = plain_components(values, 4)
    smallest = {label: min(doc for (doc, _), l in zip(rows, labels) if l == label and doc is not None) for label in labels}
    want = sorted((doc or -1, value, smallest[label]) for (doc, _), value, label in zip(rows, values, labels))
    assert sorted((r.doc_id or -1, r.fingerprint % (1 << 64), r.component_id) for r in got) == want
    if tile == 4096:
        kept = simhash.keep_first(frame_of(spark, rows))
        assert sorted({r.doc_id for r in kept.collect()}) == sorted(set(smallest.values()))
        assert kept.columns == frame_of(spark, rows).columns
        assert simhash.near_groups(frame_of(spark, [])).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 150)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in range(100, 140)}, 150: 150, 200: 150}


# Suffixes


def plain_repeats(texts, length=suffixes.LENGTH):
    seen = defaultdict(int)
    for text in texts:
        for i in range(len(text) - length + 1):
            seen[text[i:i + length]] += 1
    out = []
    for text in texts:
        cover = [False] * len(text)
        for i in range(len(text) - length + 1):
            if seen[text[i:i + length]] > 1:
                cover[i:i + length] = [True] * length
        runs = sum(c and (i == 0 or not cover[i - 1]) for i, c in enumerate(cover))
        out.append((len(text), sum(cover), runs, bytes(b for b, c in zip(text, cover) if not c)))
    return out


def repeat_texts():
    random.seed(11)
    some = lambda n: "".join(random.choice("abcdé \n") for _ in range(n))
    passage, other, long = some(700), some(460), some(3000)
    texts = [None, "", "short", some(390), "ab" * 500, "x" * 900, long, long]
    texts += [some(random.randrange(300)) + passage + some(random.randrange(300)) for _ in range(9)]
    texts += [some(50) + other[:random.randrange(380, 460)] + some(50) for _ in range(6)]
    texts += [passage[:400] + some(10) + other, passage[1:400] + some(9), long[:1500] + "!" + long[1501:]]
    return texts + [some(2000) for _ in range(4)]


@pytest.mark.parametrize("group, length, note", [(suffixes.GROUP, 400, 200), (3, 400, None), (3, 700, 90)])
def test_removed_bytes(spark, group, length, note):
    texts = repeat_texts()
    frame = frame_of(spark, list(enumerate(texts))).repartition(4)
    found = suffixes.remove_repeats(frame, group=group, length=length, note=note)
    got = {r._doc.doc_id: r for r in found.collect()}
    raw = [(text or "").encode() for text in texts]
    for at, (want, noted) in enumerate(zip(plain_repeats(raw, length), plain_repeats(raw, note or length))):
        row = got[at]
        assert (row.n_bytes, row.n_removed, row.n_spans, bytes(row.kept)) == want
        assert row.n_noted == noted[1]
    assert suffixes.remove_repeats(frame.limit(0), length=length, note=note).count() == 0
    with pytest.raises(ValueError):
        suffixes.remove_repeats(frame, length=suffixes.GRAM)


def test_passages_of_51_words_go(spark):
    random.seed(12)
    words = ["".join(random.choice("abcdefghijé") for _ in range(random.randint(2, 8))) for _ in range(900)]
    some = lambda n: " ".join(random.choices(words, k=n))
    passages = [some(51) for _ in range(8)]
    clean = [some(random.randint(20, 300)) for _ in range(60)]
    planted = [f"{some(random.randint(0, 80))} {passages[k % 8]} {some(random.randint(1, 80))}" for k in range(40)]
    frame = frame_of(spark, list(enumerate(clean + planted)))
    got = {r._doc.doc_id: r.kept for r in suffixes.remove_repeats(frame, as_text=True, length=suffixes.PASSAGE).collect()}
    assert all(len(passage.encode()) >= suffixes.PASSAGE for passage in passages)
    assert [got[k] for k in range(60)] == clean
    for k, text in enumerate(planted, 60):
        before, after = text.split(passages[(k - 60) % 8])
        assert passages[(k - 60) % 8] not in got[k] and len(got[k]) <= len(before + after)


def test_slabs_do_not_cut_windows(monkeypatch):
    random.seed(2)
    text = bytes(random.choice(b"abc") for _ in range(5000))
    whole = suffixes.segments(text, np.array([len(text)]))
    monkeypatch.setattr(suffixes, "SLAB", 700)
    starts = []
    for data, numbers, offsets, ends in suffixes._slabs([text, b"tiny", text[:450]], suffixes.LENGTH):
        at, count, anchor, key = suffixes.segments(data, ends)
        part = np.searchsorted(ends, at, side="right")
        place = at - np.r_[0, ends[:-1]][part] + np.array(offsets)[part]
        for n, p, c, a in zip(part, place, count, anchor):
            starts += [(numbers[n], p + k, p + a) for k in range(c)]
    want = [(0, p + k, p + a) for p, c, a in zip(*whole[:3]) for k in range(c)]
    assert [s for s in starts if s[0] == 0] == want
    assert sorted(s[1] for s in starts if s[0] == 2) == list(range(51))


def test_suffix_order():
    random.seed(4)
    rows = sorted((random.randrange(4), bytes(random.choice(b"ab") for _ in range(24))) for _ in range(200))
    random.shuffle(rows)
    rows.sort(key=lambda row: row[0])
    groups = np.array([g for g, _ in rows])
    order, shared = suffixes.suffix_order(suffixes._words([s for _, s in rows], 24), groups)
    assert [rows[i] for i in order] == sorted(rows)
    for place in range(1, len(order)):
        (g, a), (h, b) = rows[order[place - 1]], rows[order[place]]
        common = next((i for i in range(24) if a[i] != b[i]), 24)
        assert shared[place] == (common if g == h else -1)


# Toxicity


def test_toxicity(spark):
    random.seed(8)
    words = [f"{a}{b}{c}" for a in "bdfglm" for b in "aeiou" for c in ("ran", "tol", "sik", "mep")]
    docs, labels = [], []
    for doc in range(600):
        body = random.choices(words, k=60)
        toxic = doc % 7 == 0
        if toxic:
            for _ in range(4):
                body[random.randrange(60)] = random.choice(["Vilest", "vilely!", "scorn", "scorned,"])
        docs.append((doc, " ".join(body)))
        if doc % 2 == 0:
            labels.append((doc, 1, int(toxic)))
    docs += [(600, None), (601, ""), (None, "vilest scorn"), (3, docs[3][1])]
    labels += [(None, 0, 1), (5, None, None), (100000, 0, 1)]
    frame = frame_of(spark, docs)
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    scorer = toxicity.train(frame, known)
    rows = toxicity.score_documents(frame, scorer).collect()
    assert len(rows) == len(docs)
    for row in rows:
        doc = row._doc.doc_id
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.5)
        assert row.predicted == (1 if doc is None or (doc < 600 and doc % 7 == 0) else 0)
    none = toxicity.train(frame, known.limit(0))
    assert {r.predicted for r in toxicity.score_documents(frame, none).collect()} == {0}
    assert toxicity.score_documents(frame.limit(0), scorer).count() == 0
    assert toxicity.train(frame.limit(0), known).score("x") < 0.5


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(1)
    toxic = rng.random(4000) < 0.3
    rates = np.array([[0.02, 0.6], [0.05, 0.5], [0.3, 0.3]])
    votes = (rng.random((4000, 3)) < np.where(toxic[:, None], rates[:, 1], rates[:, 0])).astype(float)
    votes = np.column_stack([votes, votes[:, 0]])  # a voter that copies another
    labels = np.where(rng.random(4000) < 0.02, 1 - toxic, toxic).astype(float)
    model = toxicity.LabelModel(votes, np.ones(4000), labels)
    assert np.abs(model.fires[:, :3].T - rates).max() < 0.08
    assert model.correlation[0, 3] > 0.9 and model.say[0] < 0.6 < model.say[1]


def test_every_supported_word_has_a_voter(spark):
    random.seed(9)
    letters = "bcdfghjklmnpqrst"
    plain = [f"{a}{b}{c}o" for a in letters for b in "aeiou" for c in letters]
    insults = [f"{a}y{b}{c}u" for a in letters for b in letters for c in "xz"][:150]
    docs = [(at, " ".join(random.choices(plain, k=12))) for at in range(5000)]
    docs += [(5000 + at, " ".join([*random.choices(plain, k=12), insults[at % 150]])) for at in range(2100)]
    labels = spark.createDataFrame([(doc, int(doc >= 5000)) for doc, _ in docs], "doc_id bigint, toxic int")
    scorer = toxicity.train(frame_of(spark, docs), labels)
    assert all(scorer.voters.votes(word) for word in insults)
    assert all(scorer.score(f"{plain[0]} {word}") >= 0.5 for word in insults)
    assert scorer.score(" ".join(plain[:12])) < 0.5


def test_near_copies_support_a_word_once(spark):
    random.seed(10)
    words = [f"{a}{b}{c}" for a in "bdfglmnprst" for b in "aeiou" for c in ("ran", "tol", "sik", "mep", "duv")]
    body = random.choices(words, k=3000)
    rows = [(" ".join([*body, f"end{'abcdefghij'[at % 10] * (1 + at // 10)}"]), 1) for at in range(40)]
    rows += [(" ".join([*random.choices(words, k=200), "vilest"]), 1) for _ in range(5)]
    rows += [(" ".join(random.choices(words, k=200)), 0) for _ in range(30)] + [(" ".join([*body, "clean"]), 0)]
    frame = toxicity.with_fingerprints(spark.createDataFrame(rows, "text string, toxic int").repartition(8))
    counts = {r.feature: (r.toxic, r.clean) for r in toxicity.candidate_counts(frame).collect()}
    assert counts["vilest "] == (5, 0) and counts["enda "] == (1, 0) and counts[""] == (6, 31)
    values = [random.getrandbits(64) for _ in range(40)]
    values += [value ^ (0b1111 << random.randrange(60)) for value in values[:20]] + values[:5]
    group, want = toxicity.near_groups(values), plain_components(values, toxicity.NEAR)
    assert len(set(zip(group.tolist(), want))) == len(set(group.tolist())) == len(set(want))


# Urls


def test_urls(spark):
    cases = [
        ("http://a.Example.NET/en/x?y#z", "a.example.net", "/en/x", "example.net/en/", "allow"),
        ("http://example.net/enx", "example.net", "/enx", "net/", "block"),
        ("http://net", "net", "", None, "allow"), ("x://y.net?/a", "y.net", "", None, "allow"),
        ("http://example.com/de/#q", "example.com", "/de/", "example.com/de/", "block"),
        ("http://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
        ("http://b.org/fr/://c", "b.org", "/fr/://c", "org/fr/", "allow"),
        (None, "", "", None, "allow"), ("no scheme.net/", "", "", None, "allow"),
        ("://ÄB.net/x", "Äb.net", "/x", "net/", "block"), ("http://bad.com/", "bad.com", "/", None, "block"),
    ]
    pages = spark.createDataFrame([(i, case[0], "h") for i, case in enumerate(cases)], "page_id bigint, url string, rule string")
    more = spark.range(100, 140).selectExpr(
        "id AS page_id", "concat('http://', CASE WHEN id < 120 THEN 'bad.com/' ELSE 'good.com/' END, id) AS url", "'h' AS rule")
    outcomes = spark.range(100, 140).selectExpr("id AS page_id", "CASE WHEN id < 120 THEN 1 ELSE 0 END AS bad")
    got = {r.page_id: tuple(r)[1:] for r in urls.judge_urls(pages.unionByName(more), outcomes).collect()}
    assert len(got) == len(cases) + 40
    for at, case in enumerate(cases):
        assert got[at] == case[1:], case
    assert urls.judge_urls(pages.limit(0), outcomes).count() == 0
    assert urls.judge_urls(pages, outcomes.limit(0)).filter("verdict = 'block'").count() == 3


def test_host_levels(spark):
    cases = [("a.b.example.com", "example.com", "com"), ("x.shop.co.uk:8080", "shop.co.uk", "co.uk"),
             ("co.uk", "co.uk", "co.uk"), ("me:pw@www.site.org:80", "site.org", "org"), ("10.1.2.3:99", "10.1.2.3", "[]"),
             ("[2001:db8::1]:80", "[2001:db8::1]", "[]"), ("localhost", "localhost", "localhost"), ("", "", "")]
    frame = spark.createDataFrame([(host,) for host, *_ in cases], "host string")
    rows = frame.select("host", *urls.host_levels(F.col("host"))).collect()
    assert sorted(map(tuple, rows)) == sorted(cases)


def test_a_blocked_host_is_the_same_in_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    spark.range(0, 400).selectExpr(
        "id AS page_id", "concat('http://', element_at(array('bad.example.com', 'good.example.com', 'x.org', "
        "'a.net', 'b.example.net'), CAST(id % 5 + 1 AS INT)), '/en/', id * 7, '?q') AS url", "'h' AS html"
    ).write.parquet(f"{tmp_path}/pages.parquet")
    spark.range(0, 2800).selectExpr(
        "id AS doc_id", "CAST(CASE WHEN id % 7 = 0 AND (id / 7) % 5 = 0 THEN 0 ELSE 1 END AS INT) AS quality", "0 AS toxic"
    ).write.parquet(f"{tmp_path}/labels.parquet")
    ours = sorted(map(tuple, queries.op7_url_filters(spark, str(tmp_path)).collect()))
    database = duckdb.connect()
    for name in ("pages", "labels"):
        database.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert ours == sorted(database.execute(queries.ORACLES["op7_url_filters"]).fetchall())
    by_method = {row[1] for row in ours if row[3] is None and row[4] == "block"}
    assert by_method == {"bad.example.com"}


def test_outcomes_follow_the_document_of_the_path(spark, tmp_path):
    tails = ["", "/", ".html", "#top", "?page=2&ref=x"]
    rows = [(i, f"http://{'bad' if i < 40 else 'good'}.com/en/{9000 + i // 2}{tails[i % 5]}") for i in range(80)]
    rows += [(80, "http://other.com/en/99999999999999999999"), (81, "http://other.com/9001"), (82, None), (9001, "http://last.com/")]
    spark.createDataFrame(rows, "page_id bigint, url string").write.parquet(str(tmp_path / "pages.parquet"))
    labels = [(9000 + i, 1, int(i < 20)) for i in range(40)] + [(i, 1, int(i >= 40)) for i in range(80)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r.page_id: r.verdict for r in queries.op7_url_filters(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    assert {page for page, verdict in got.items() if verdict == "block"} == set(range(40))
    split = spark.createDataFrame([("h", 1), ("h", 1), ("g", 1), ("g", None)], "host string, doc_id bigint")
    known = spark.createDataFrame([(1, 1), (1, 0), (None, 1)], "doc_id bigint, bad int")
    counts = {r.host: (r.pages, r.bad) for r in urls.host_reputation(split, known, key="doc_id").collect()}
    assert counts == {"h": (4, 2), "g": (2, 1)}


# Pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    kept = [docs]
    for name, stage in pipeline.STAGES:
        kept.append(park(stage(spark, kept[-1], FOLDER), "stage"))
    frames = [frame.toPandas() for frame in kept]
    for frame in frames[:-1]:
        assert list(frame.columns) == columns
    clean, distinct, first, cut, pieces = frames[1:]
    assert set(clean.doc_id) <= set(frames[0].doc_id)
    plain = clean.text.str.replace(r"[\x20\x09-\x0D]", "", regex=True)
    assert len(distinct) == plain.nunique()
    values = [plain_fingerprint(text) for text in distinct.text]
    labels = plain_components(values, 4)
    assert set(first.doc_id) == {min(d for d, l in zip(distinct.doc_id, labels) if l == label) for label in labels}
    want = plain_repeats([text.encode() for text in first.text])
    by_id = dict(zip(cut.doc_id, cut.text))
    for doc, row in zip(first.doc_id, want):
        assert by_id[doc].encode() == row[3] or b"\xc3" in row[3]
    assert set(pieces.doc_id) == set(cut.doc_id)
    again = pipeline.run(spark, FOLDER).toPandas()
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, again[key].values)) == sorted(map(tuple, pieces[key].values))
    none = pipeline.drop_near_copies(spark, pipeline.drop_exact_copies(spark, docs.limit(0), FOLDER), FOLDER)
    assert pipeline.pack(spark, pipeline.cut_repeats(spark, none, FOLDER), FOLDER).count() == 0
