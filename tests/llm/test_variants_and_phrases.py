"""Spelling variants, min-max near-duplicates and phrase collocations against plain versions."""

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from vereda.llm import minmax, phrases, spelling

DOCS = "doc_id bigint, text string, lang string, n bigint, key string, word string, cls string, root int"


def frame_of(spark, rows, lang="en"):
    return spark.createDataFrame(
        [(row[0], row[1], row[2] if len(row) > 2 else lang, 7, "k", "w", "c", 1) for row in rows], DOCS
    )


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# Spelling variants


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def plain_variants(rows, every=97):
    counts = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered(text)):
            mark = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if every and mark % every == 0:
                run = run[:mark % len(run)] + run[mark % len(run) + 1:]
            if len(run) >= 5:
                counts[run] += 1
    counts = {word: n for word, n in counts.items() if n >= 3}
    near = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and edit_distance(v, w) == 1] for w in counts}
    form = {}
    for word, others in near.items():
        if others:
            best = min(others, key=lambda v: (-counts[v], v))
            if counts[best] >= 2 * counts[word]:
                form[word] = best
    out = set()
    for word, n in counts.items():
        root = word
        while root in form:
            root = form[root]
        best = form.get(word)
        out.add((word, best, root, n, len(near[word]), counts.get(best)))
    return out


@pytest.mark.parametrize("every", [97, 3, 0])
def test_variants(spark, every):
    rng = random.Random(4)
    stems = ["".join(rng.choices("abé", k=rng.randint(4, 8))) for _ in range(40)]

    def word():
        stem = rng.choice(stems)
        if rng.random() < 0.5:
            at = rng.randrange(len(stem) + 1)
            stem = stem[:at] + rng.choice(["", "a", "É", "z", "ÿ"]) + stem[at + rng.randint(0, 1):]
        return stem.upper() if rng.random() < 0.1 else stem

    rows = [(k, " ".join(word() for _ in range(60)) + "-5x") for k in range(40)]
    rows += [(None, "Straße straße STRASSE"), (None, "Straße straße STRASSE"), (7, None), (8, ""), (9, "a" * 3000)] * 3
    for size in (20_000, 5):
        got = spelling.variant_groups(frame_of(spark, rows), every=every, size=size).collect()
        assert {tuple(r) for r in got} == plain_variants(rows, every) and len(got) == len(set(got))


def test_variants_of_chains_ties_and_nothing(spark):
    text = "abcde " * 16 + "abcdef " * 8 + "abcdefg " * 4 + "bbbbb " * 3 + "bbbbc " * 6 + "bbbba " * 6
    found = {r.word: r for r in spelling.variant_groups(frame_of(spark, [(1, text)]), every=0).collect()}
    assert found["abcdefg"].root == "abcde" and found["abcdefg"].form == "abcdef"
    assert found["bbbbb"].form == "bbbba" and found["bbbbb"].n_near == 2 and found["bbbbc"].form is None
    assert found["abcde"].root == "abcde" and found["abcde"].form_n is None
    assert spelling.variant_groups(frame_of(spark, [])).count() == 0
    assert spelling.variant_groups(frame_of(spark, [(1, "a b c")])).count() == 0


def test_a_hot_half_is_dealt_again(spark):
    rng = random.Random(5)
    rows = [(1, " ".join("samehalf" + "".join(rng.choices("abcdefgh", k=8)) for _ in range(300)))] * 3
    words = spelling.vocabulary(frame_of(spark, rows), every=0)
    lists = spelling.deal(words, size=20).groupBy("list").count()
    assert lists.agg({"count": "max"}).first()[0] <= 20
    got = spelling.variant_groups(frame_of(spark, rows), every=0, size=20).collect()
    assert {tuple(r) for r in got} == plain_variants(rows, 0)


# Min-max near-duplicates


def plain_near(rows, words=5, percent=85):
    sets = []
    for _, text, *_ in rows:
        parts = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
        sets.append({tuple(parts[i:i + words]) for i in range(max(1, len(parts) - words + 1))} if parts else set())
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in combinations(range(len(rows)), 2):
        shared = len(sets[x] & sets[y])
        if shared and 100 * shared >= percent * len(sets[x] | sets[y]):
            parent[top(x)] = top(y)
    lowest = defaultdict(list)
    for x, (doc, *_) in enumerate(rows):
        if doc is not None:
            lowest[top(x)].append(doc)
    out = Counter()
    for x, (doc, *_) in enumerate(rows):
        component = doc if not sets[x] else min(lowest[top(x)], default=None)
        out[(doc, len(sets[x]), component, doc == component)] += 1
    return out


def near_rows():
    rng = random.Random(6)
    words = [f"w{k}" for k in range(400)]
    rows, number = [], 0
    for _ in range(12):
        base = rng.choices(words, k=rng.randint(20, 200))
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((number, " ".join(copy)))
            number += 1
            base = copy if rng.random() < 0.5 else base  # chains: the ends are not near
    passage = " ".join(rng.choices(words, k=60))
    rows += [(1000 + k, passage + " " + " ".join(rng.choices(words, k=60))) for k in range(30)]
    rows += [(2000, "Four words only here"), (2001, "four  words\nonly here"), (2002, "four words only"),
             (2003, None), (2004, ""), (2005, " \t"), (3, rows[3][1]), (3, rows[3][1]), (None, rows[5][1]),
             (None, "nobody else says any of this"), (2006, "x y z " * 4000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limits", [{}, {"tile": 3}, {"tile": 4, "crowd": 6}])
def test_near_documents(spark, limits):
    rows = near_rows()
    got = minmax.near_documents(frame_of(spark, rows), **limits).collect()
    assert Counter(tuple(r) for r in got) == plain_near(rows)
    assert minmax.near_documents(frame_of(spark, [])).count() == 0


def test_one_evaluation_gives_two_values():
    rng = np.random.default_rng(7)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = np.unique(pool[:2600]), np.unique(pool[400:])
    truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    x, y = minmax.min_max(a), minmax.min_max(b)
    assert x.shape == (2, minmax.PERMUTATIONS) and (x[0] <= x[1]).all()
    assert abs((x == y).mean() - truth) < 0.15
    assert len(set(minmax.band_keys(x).tolist())) == minmax.PERMUTATIONS // minmax.BAND


def test_blocks_find_a_spanning_forest():
    rng = random.Random(8)
    base = [np.array(rng.sample(range(200), 60)) for _ in range(4)]
    sets = [np.unique(np.r_[base[k % 4], [1000 + k]]) for k in range(40)]
    edges = minmax.link_sets(list(range(40)), sets)
    assert len(edges) == 36 and all(x % 4 == y % 4 for x, y in edges)
    assert minmax.link_sets([k % 4 for k in range(40)], sets) == []


# Phrases


def plain_collocations(rows, fewest, best):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered(text)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, 6):
                counts.update((lang, *words[i:i + size]) for i in range(len(words) - size + 1))
    frequent = {gram: f for gram, f in counts.items() if f >= fewest}
    inside = {
        (gram[0], *gram[i:j]) for gram, f in frequent.items()
        for i in range(1, len(gram)) for j in range(i + 2, len(gram) + 1)
        if j - i < len(gram) - 1 and 100 * f >= 100 * frequent[(gram[0], *gram[i:j])]
    }
    found = defaultdict(list)
    for gram, a in frequent.items():
        if len(gram) > 2 and gram not in inside:
            n = totals[gram[0]]
            score, _, l, r = min(
                (1000 * a * n // (frequent[gram[:k]] * frequent[(gram[0], *gram[k:])]), k,
                 frequent[gram[:k]], frequent[(gram[0], *gram[k:])]) for k in range(2, len(gram))
            )
            found[gram[0]].append((-score, -a, " ".join(gram[1:]).encode(), l, r, n))
    return {
        (lang, rank, phrase.decode(), -a, l, r, n, -score)
        for lang, each in found.items()
        for rank, (score, a, phrase, l, r, n) in enumerate(sorted(each)[:best], 1)
    }


def phrase_rows():
    rng = random.Random(9)
    words = ["The", "of", "é", " x", "ab", "a", "b", "c-d"] + [f"v{k}" for k in range(30)]
    idioms = ["by and large", "a b a b a", "in the long run it", "è à", "Of course"]
    rows = []
    for k in range(120):
        text = "".join(
            (rng.choice(idioms) if rng.random() < 0.3 else rng.choice(words)) + rng.choice([" ", " ", "\t ", ". ", "\n", ","])
            for _ in range(rng.randint(0, 90))
        )
        rows.append((k, text, rng.choice(["en", "en", "fr", None, "und"])))
    return rows + [(500, None, "en"), (501, "", None), (502, " .,", "xx"), (3, rows[3][1], "en"), (3, rows[3][1], "en")]


@pytest.mark.parametrize("bits, shards, best", [(16, 3, 2000), (6, 2, 7)])
def test_collocations(spark, bits, shards, best):
    rows = phrase_rows()
    got = phrases.collocations(frame_of(spark, rows), fewest=12, best=best, shards=shards, bits=bits).collect()
    wanted = plain_collocations(rows, 12, best)
    assert {tuple(r) for r in got} == wanted and len(got) == len(wanted) > 10


def test_long_texts_are_read_in_parts():
    rng = random.Random(10)
    text = "".join(rng.choice(["ab", "c", "é", "long" * 20]) + rng.choice([" ", "  ", "\t", ".", "\n"]) for _ in range(3000)).encode()
    parts = list(phrases._parts(text, slab=500))
    assert b"".join(part[:own] for part, own in parts) == text and len(parts) > 20
    counts = [Counter(), Counter()]
    for into, pieces in zip(counts, (parts, [(text, len(text))])):
        for part, own in pieces:
            words = phrases.Words(part, np.array([0]), np.array([own]), np.array([0]), ["en"])
            for length in range(1, 6):
                at = np.flatnonzero(words.own & (words.room >= length))
                into.update(words.phrase(place, length) for place in at.tolist())
    assert counts[0] == counts[1]


def test_scores_beyond_64_bits_and_nothing(spark):
    assert phrases.collocations(frame_of(spark, [])).count() == 0
    assert phrases.collocations(frame_of(spark, [(1, None), (2, "a b")])).count() == 0
    row = spark.range(1).selectExpr(phrases.SCORE.format(a="90000000000000", n="800000000000000", l="7000000", r="11000000") + " AS s")
    assert row.first().s == 1000 * 90000000000000 * 800000000000000 // (7000000 * 11000000)
