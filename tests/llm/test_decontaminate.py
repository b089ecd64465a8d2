"""Leaks against brute force over every offset, and planted substitutions."""

import random
import re
from itertools import combinations

import pytest

from riverbend.llm import decontaminate as D
from riverbend.sources.tables import read_table

from conftest import SF_MID

SCHEMA = "doc_id long, text string, item_id string, item int"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def overlap(doc, item):
    """Best (equal, first, n) of the item over all offsets of the document, by the stated rule, where a window fits a mask."""
    best = None
    if not item:
        return None
    masks = [*D.MASKS, *(["1" * len(item)] if len(item) < len(D.MASKS[0]) else [])]
    for start in range(1 - len(item), len(doc)):
        lo, hi = max(start, 0), min(start + len(item), len(doc))
        same = [doc[p] == item[p - start] for p in range(lo, hi)]
        if not any(all(same[k + j] for j, c in enumerate(m) if c == "1") for m in masks for k in range(len(same) - len(m) + 1)):
            continue
        runs = [(sum(1 if x else D.PENALTY for x in same[a:b]), -b, -a, a, b) for a, b in combinations(range(len(same) + 1), 2)]
        *_, a, b = max(runs)
        equal = sum(same[a:b])
        if equal >= min(D.MIN_EQUAL, len(item)) and equal >= D.MIN_SHARE * len(item) or equal >= D.LONG_EQUAL:
            best = max(best or (0, 0), (equal, -(lo + a)))
    return best and (best[0], -best[1])


def seeds(doc, item):
    """Offsets at which a window of the item under a mask stands in the document."""
    masks = [*D.MASKS, *(["1" * len(item)] if len(item) < len(D.MASKS[0]) else [])]
    out = set()
    for m in masks:
        marked = [j for j, c in enumerate(m) if c == "1"]
        known = {}
        for k in range(len(item) - len(m) + 1):
            known.setdefault(tuple(item[k + j] for j in marked), []).append(k)
        for p in range(len(doc) - len(m) + 1):
            out.update(p - k for k in known.get(tuple(doc[p + j] for j in marked), []))
    return sorted(out)


def longest_quote(doc, item, starts):
    best = (0, 0)
    for start in starts:
        run = 0
        for p in range(max(start, 0), min(start + len(item), len(doc))):
            run = run + 1 if doc[p] == item[p - start] else 0
            best = max(best, (run, run - 1 - p))
    return best[0], -best[1]


def aligned(doc, item, starts):
    """The most equal words of a best local alignment over the places near a cluster of offsets, as (score, equal)."""
    best = (0, 0)
    clusters = [[starts[0]]] if starts else []
    for x in starts[1:]:
        if x - clusters[-1][-1] > D.BAND:
            clusters.append([])
        clusters[-1].append(x)
    for c in clusters:
        lo, hi = c[0] - D.BAND, c[-1] + D.BAND
        cells = {}
        for i, w in enumerate(item):
            for p in range(max(lo + i, 0), min(hi + i + 1, len(doc))):
                # one before on the same offset, after left-out words of the item, or after inserted words
                step = (1, 1) if doc[p] == w else (D.PENALTY, 0)
                come = [(0, 0)]
                for di, dp in [(1, 1), *((1, 1 + n) for n in range(1, hi - lo + 1)), *((1 + n, 1) for n in range(1, hi - lo + 1))]:
                    if (got := cells.get((i - di, p - dp))) is not None:
                        come.append((got[0] + D.PENALTY * (di - 1 + dp - 1), got[1]))
                top = max(come)
                cells[i, p] = (top[0] + step[0], top[1] + step[1])
                best = max(best, cells[i, p])
    return best


def enough(equal, item):
    return equal >= min(D.MIN_EQUAL, len(item)) and equal >= D.MIN_SHARE * len(item) or equal >= D.LONG_EQUAL


def holds(doc, item):
    """Whether an item counts in a document by any of the three rules."""
    starts = seeds(doc, item)
    if not item or not starts:
        return False
    if overlap(doc, item) or enough(aligned(doc, item, starts)[1], item):
        return True
    return longest_quote(doc, item, starts)[0] >= min(D.VERBATIM, max(D.MIN_EQUAL, len(item) // 2))


# a filter that is far too small lets more windows through and changes nothing
@pytest.mark.parametrize("filter_bits", [1 << 29, 512])
def test_equals_brute_force(spark, filter_bits):
    rnd = random.Random(4)
    vocabulary = [f"v{k}" for k in range(300)]
    items = [(k, " ".join(rnd.choices(vocabulary, k=rnd.choice([2, 3, 4, 5, 6, 9, 12, 30, 60]))) + ".") for k in range(25)]
    items += [(50, None), (51, ""), (52, "the the the the the the the the the the"), (None, items[4][1]), (53, items[5][1])]
    docs = []
    for k in range(80):
        body = rnd.choices(vocabulary, k=rnd.choice([0, 4, 40, 120]))
        if k % 2:
            part = words(rnd.choice(items[:25])[1])
            for at in rnd.sample(range(len(part)), rnd.choice([0, 0, 1, 2, len(part) // 3])):
                part[at] = "other"
            cut = rnd.choice([0, 0, len(part) // 3])
            body[len(body) // 2:len(body) // 2] = part[cut:]
        docs.append((k, ", ".join(body).title()))
    docs += [(90, None), (91, ""), (92, "the " * 200), (None, items[3][1]), (0, docs[0][1])]
    found = D.find_leaks(spark.createDataFrame([(*d, "x", 1) for d in docs], SCHEMA),
                         spark.createDataFrame([(*i, 9) for i in items], "item_id long, text string, doc_id int"), filter_bits=filter_bits).collect()
    expected = []
    for i, text in docs:
        for j, t in items:
            if got := overlap(words(text), words(t)):
                expected.append((i, j, len(words(t)), *got))
    assert sorted(((r.doc_id, r.item_id, r.item_words, r.equal_words, r.first_word) for r in found), key=repr) == sorted(expected, key=repr)
    clean = D.remove_leaks(spark.createDataFrame([(*d, "x", 1) for d in docs], SCHEMA),
                           spark.createDataFrame(items, "item_id long, text string"), filter_bits=filter_bits)
    assert clean.columns == ["doc_id", "text", "item_id", "item"]
    bad = {text for i, text in docs if any(overlap(words(text), words(t)) for _, t in items)}
    assert sorted((r.text or "" for r in clean.collect())) == sorted(t or "" for _, t in docs if t not in bad)


def test_masks_tolerate_the_stated_substitutions():
    for n, lost in ((10, 1), (12, 2), (16, 3)):
        for places in combinations(range(n), lost):
            assert any(all(k + j not in places for j, c in enumerate(m) if c == "1") for m in D.MASKS for k in range(n - len(m) + 1))


def test_empty_tables_and_a_very_long_text(spark):
    item = " ".join(f"i{k}" for k in range(20))
    one = spark.createDataFrame([(1, "x " * 300_000 + item)], "doc_id long, text string")
    bench, none = spark.createDataFrame([(7, item)], "item_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert [(r.item_id, r.equal_words, r.first_word) for r in D.find_leaks(one, bench).collect()] == [(7, 20, 300_000)]
    assert D.find_leaks(one, none).count() == 0 and D.remove_leaks(one, none).count() == 1
    assert D.find_leaks(none.withColumnRenamed("item_id", "doc_id"), bench).count() == 0


def plain_alignment(doc, item):
    """The least score that no local alignment of the two exceeds (+1 equal, -1 another, inserted or dropped word)."""
    best, row = 0, [0] * (len(doc) + 1)
    for w in item:
        new = [0]
        for j, d in enumerate(doc):
            new.append(max(0, row[j] + (1 if d == w else -1), row[j + 1] - 1, new[j] - 1))
        best, row = max(best, *new), new
    return best


def test_alignment_equals_plain_version():
    import pyarrow as pa

    rnd = random.Random(8)
    for _ in range(300):
        item = rnd.choices("abcdefghijklmnop", k=rnd.choice([5, 9, 14]))
        doc = [w for w in item if rnd.random() > 0.15]
        for _ in range(rnd.choice([0, 1, 3])):
            doc.insert(rnd.randrange(len(doc) + 1), rnd.choice("abcxyz"))
        pair = D.Pair(D.words(pa.array([" ".join(item)]))[0], D.words(pa.array([" ".join(doc)]))[0], 7)
        pair.enough = lambda equal: True
        got = pair.align(7, 7)
        score = plain_alignment(doc, item)
        if not score:
            assert got is None
            continue
        equal, first, n = got
        part = doc[first - 7:first - 7 + n]
        assert len(part) == n >= equal >= score and plain_alignment(part, item) == score


def test_all_rules_equal_brute_force(spark):
    """Substituted, inserted and dropped words and quotes of any length, each pair of document and item."""
    rnd = random.Random(12)
    items = [(k, [f"i{k}x{j % rnd.choice([7, 99])}" for j in range(rnd.choice([1, 3, 4, 5, 7, 8, 10, 13, 17, 24, 40]))]) for k in range(24)]
    docs = []
    for k in range(160):
        item = list(rnd.choice(items)[1])
        for _ in range(rnd.choice([0, 1, 2, 5])):
            at = rnd.randrange(len(item) + 1)
            rule = rnd.randrange(3)
            item[at:at + (rule < 2)] = ["changed"] if rule else []
            if not item:
                break
        cut = sorted(rnd.choice([0, 0, len(item)]) if rnd.random() < 0.5 else rnd.randrange(len(item) + 1) for _ in range(2))
        part = item[cut[0]:cut[1]] or item
        docs.append((k, [f"n{rnd.randrange(99)}" for _ in range(rnd.randrange(25))] + part + [f"n{rnd.randrange(99)}" for _ in range(rnd.randrange(25))]))
    expected = {(i, j) for i, doc in docs for j, item in items if holds(doc, item)}
    found = D.find_leaks(spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string"),
                         spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected and 40 < len(expected) < 160


@pytest.mark.parametrize("n_doc", [0, 1, 3, 4, 5, 6, 7, 8, 9, 10, 12])
def test_batches_of_few_words(spark, n_doc):
    text = [f"w{k}" for k in range(12)]
    docs = spark.createDataFrame([(1, " ".join(text[:n_doc]))], "doc_id short, text string")
    items = [(n, " ".join(text[:n])) for n in range(13)]
    expected = {n for n, t in items if holds(text[:n_doc], text[:n])}
    assert expected >= {n for n in range(1, min(n_doc, 12) + 1)}
    for some in ([items[n_doc]], items):
        bench = spark.createDataFrame(some, "item_id short, text string")
        assert {r.item_id for r in D.find_leaks(docs, bench).collect()} == expected & {n for n, _ in some}
        assert D.remove_leaks(docs, bench).count() == (not expected & {n for n, _ in some})


def test_one_text_in_a_third_of_the_benchmark(spark):
    item = " ".join(f"i{k}" for k in range(20))
    bench = spark.createDataFrame([(k, item if k % 3 == 0 else f"own {k} text of an item that is not held by anything {k}") for k in range(300)], "item_id long, text string")
    docs = spark.createDataFrame([(k, f"noise {k} {item} end") for k in range(5)] + [(9, "clean")], "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in D.find_leaks(docs, bench).collect()) == [(d, k) for d in range(5) for k in range(0, 300, 3)]
    assert [r.doc_id for r in D.remove_leaks(docs, bench).collect()] == [9]


def test_columns_and_types_of_any_kind(spark):
    item = " ".join(f"i{k}" for k in range(20))
    docs = spark.sql(f"SELECT cast('1.5' AS decimal(5,1)) AS doc_id, '{item}' AS text, 1 AS `a.b`, 2 AS key, 3 AS row, 4 AS maybe UNION ALL SELECT null, null, 5, 6, 7, 8")
    bench = spark.sql(f"SELECT date'2024-01-01' AS item_id, '{item}' AS text, 1 AS `x.y`")
    assert [(str(r.doc_id), str(r.item_id)) for r in D.find_leaks(docs, bench).collect()] == [("1.5", "2024-01-01")]
    clean = D.remove_leaks(docs, bench)
    assert clean.columns == docs.columns and [tuple(r) for r in clean.collect()] == [(None, None, 5, 6, 7, 8)]


def test_insertions_deletions_and_quotes(spark):
    rnd = random.Random(6)
    noise = lambda k: " ".join(f"n{rnd.randrange(10**6)}" for _ in range(k))
    items = {r.item_id: words(r.text) for r in read_table(spark, SF_MID, "benchmark", ["item_id", "text"]).collect()}
    items |= {1000 + n: [f"i{n}x{k}" for k in range(n)] for n in range(11, 60)}
    docs, expected = [], set()
    for i, item in items.items():
        h, n = len(item) // 2, len(item)
        forms = [item[:h] + ["inserted"] + item[h:], item[:h] + ["two", "more"] + item[h:]]
        if n >= 13:
            forms.append(item[:h] + item[h + 1:])
        if n >= 16:
            forms += [item[:h], item[-h:], item[:h] + [*map(str, range(60))]]
        if n >= 24:
            forms.append([w for k in range(0, n, 8) for w in [*item[k:k + 8], "x"]])
        for form in forms:
            expected.add((len(docs), i))
            docs.append((len(docs), f"{noise(30)} {' '.join(form)} {noise(30)}"))
    clean = [(10**6 + k, f"{noise(20)} {' '.join(item[:6])} {noise(20)} {' '.join(item[-6:])} {noise(20)}") for k, item in items.items() if len(item) >= 16]
    table = spark.createDataFrame(docs + clean, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    rows = D.find_leaks(table, bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == expected
    assert {r.doc_id for r in D.remove_leaks(table, bench).collect()} == {i for i, _ in clean}
    short = {r.item_id: r for r in rows if r.item_id == 1012}
    assert (short[1012].equal_words, short[1012].first_word) == (12, 30)
