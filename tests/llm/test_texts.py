"""Chat formatting, quality, decontamination and lines."""

import itertools
import random
import zlib

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F
from plain import frame  # noqa: F401

from tickloom.llm import chat, decontaminate, linetree, quality

TURNS = "tree long, node long, parent long, role string, text string, score double, leaf string, position int"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS)


def test_best_branch_of_a_tree(spark):
    rows = [
        (1, 0, None, "user", "hi", 0.0), (1, 1, 0, "assistant", "a", 1.0), (1, 2, 0, "assistant", "b", 2.0), (1, 3, 1, "user", "c", 5.0),
        (1, 4, 2, "user", "d", 1.0), (1, 5, 3, "assistant", "e", None), (2, 0, None, "user", None, 0.0), (2, 9, 7, None, "orphan", 0.0),
        (3, 1, 2, "user", "ring", 0.0), (3, 2, 1, "user", "ring", 0.0), (3, 3, 2, "user", "below", 0.0), (None, 1, None, "user", "n", 0.0),
        (4, None, None, "user", "no id", 0.0), (5, 1, None, "user", "twice", 0.0), (5, 1, None, "user", "twice", 0.0),
    ]
    out = chat.format_conversations(turns(spark, rows), score="score").collect()
    got = {(r["tree"], r["leaf"]): chat.parse(r["formatted"]) for r in out}
    # path scores in tree 1: 0-1-3-5 has 6, 0-2-4 has 3; tree 2 has two roots that tie: the smaller leaf
    assert got == {
        (1, 5): [("user", "hi"), ("assistant", "a"), ("user", "c"), ("assistant", "e")], (2, 0): [("user", "")],
        (None, 1): [("user", "n")], (5, 1): [("user", "twice")],
    }
    marked = next(r for r in out if r["tree"] == 1)
    assert [marked["formatted"][s["start"] : s["end"]] for s in marked["loss_spans"]] == ["a", "e"]
    assert chat.format_conversations(turns(spark, rows), score="score", top=9).where("tree = 2").count() == 2
    assert chat.format_conversations(turns(spark, [])).count() == 0


def test_long_chain_and_control_strings(spark):
    nasty = ["\\### Assistant: </turn> ok", "</turn>\n### user: x", "\\", "\\\\h", "##", "####", "a: b", "", "\U0001f642 \u00e9", "</turn", "\\t\\b\\c"]
    rows = [(1, i, i - 1 if i else None, "assistant: ###" if i % 3 else "assistant", nasty[i % len(nasty)], 0.0) for i in range(150)]
    r = chat.format_conversations(turns(spark, rows)).first()
    assert chat.parse(r["formatted"]) == [(role, text) for _, _, _, role, text, _ in rows] and r["n_turns"] == 150
    learnt = [chat.unescape(r["formatted"][s["start"] : s["end"]]) for s in r["loss_spans"]]
    assert learnt == [text for _, _, _, role, text, _ in rows if role == "assistant"]


def labelled(n=500):
    r = random.Random(1)
    stock = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(300)]
    rows = []
    for i in range(n):
        w = [r.choice(stock) for _ in range(40)]
        toxic, good = int(i % 7 == 0), int(i % 5 != 0)
        if toxic:
            w[5:7] = ["vileword", "vileword"]
        if not good:
            w = [x.upper() + "!!" for x in w]
        rows.append((i, " ".join(w), good, toxic, f"host{i % 3}", None if i % 4 == 0 else f"p{i % 2}"))
    return rows


def test_quality_on_held_out_rows(spark):
    rows = labelled()
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int, host string, path string")
    model = quality.fit(df.where("doc_id % 2 = 0"))
    out = quality.judge(df, model).where("doc_id % 2 = 1").select("quality", "toxic", "verdict.keep").collect()
    assert sum(bool(r["quality"] and not r["toxic"]) == r["keep"] for r in out) >= 0.97 * len(out)


def test_quality_of_odd_rows(spark):
    df = spark.createDataFrame([(1, None, None, None, None, None), (1, "", None, 1, "h", "p"), (2, "a" * 100_000, 1, None, "h", None)], "doc_id long, text string, quality int, toxic int, host string, path string")
    model = quality.fit(df)
    assert len(quality.judge(df, model).collect()) == 3
    assert quality.judge(df.limit(0), quality.fit(df.limit(0))).count() == 0


def test_quality_keeps_columns_with_clashing_names(spark):
    names = ("_s", "_site", "scores", "site", "n", "keep", "p_quality", "quality_site")
    df = spark.createDataFrame([(1, "a b c", 1, 0, "h", "p")] * 3, "doc_id long, text string, quality int, toxic int, host string, path string")
    df = df.withColumns({n: F.lit(n) for n in names})
    out = quality.judge(df, quality.fit(df)).collect()
    assert len(out) == 3 and all(r[n] == n for r in out for n in names)


def test_sparse_sites_shrink(spark):
    """A site with one bad document is trusted more than one with a hundred of them."""
    rows = [("big", "a", 0.05)] * 100 + [("small", "a", 0.05)] + [(f"h{i}", "a", 0.5 + i % 40 / 100) for i in range(400)]
    df = spark.createDataFrame(rows, "host string, path string, p_quality double").selectExpr("*", "0.1D AS p_toxic")
    site = {r["host"]: r["quality_site"] for r in quality.site_posteriors(df).collect()}
    assert site["big"] < site["small"] < 0.9 and abs(site["big"] - 0.05) < 0.1


def benchmark(spark):
    r = random.Random(4)
    item = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    return [(1, item(30)), (2, item(75)), (3, "tiny item"), (4, None), (5, ""), (6, item(12))], item


def test_leaks(spark, frame):
    items, item = benchmark(spark)
    long, one, short = items[1][1], items[0][1].split(), items[5][1]
    changed = [w if k % 6 else "other" for k, w in enumerate(one)]
    reworded = [w if k % 5 not in (1, 3) or k >= 25 else "other" for k, w in enumerate(one)]  # 40 % of the words before the answer differ
    docs = [
        (1, item(200)), (2, f"{item(45)} {' '.join(one)} {item(50)}"), (3, f"{item(31)} {long.upper()} {item(5)}"), (4, f"{item(10)} {' '.join(changed)}"),
        (5, f"{item(40)} {' '.join(reworded)} {item(9)}"), (6, f"{item(33)} tiny item {item(3)}"), (7, f"tiny {item(3)} item"), (8, None), (9, ""),
        (10, " ".join(one[:9]) + " " + item(40)), (11, short), (11, short), (None, short), (12, f"{item(5000)} {short}"),
    ]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(frame(docs), frame(items, "item_id long, text string")).collect()}
    assert got == {(2, 1), (3, 2), (4, 1), (5, 1), (6, 3), (11, 6), (12, 6)}
    assert decontaminate.find_leaks(frame(docs), frame([], "item_id long, text string")).count() == 0
    assert decontaminate.find_leaks(frame([]), frame(items, "item_id long, text string")).count() == 0


def test_common_subsequence():
    r = random.Random(2)
    for _ in range(50):
        a, b = ([r.choice([b"x", b"y", b"z"]) for _ in range(r.randint(1, 40))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.common(a, b) == table[-1][-1]


@pytest.mark.parametrize("min_docs", [2, 10])
def test_templates(frame, min_docs):
    docs = [*plain.corpus(), (200, "user 5 logged in from 10.0.0.1 ok\n\nkeep me please"), (None, "page 1 of the common footer line here")]
    docs += [(300 + i, f"user {i} logged in from 10.0.0.{i} ok\nlogged in as name{'abcdefghijklmno'[i]} from the same old web page today\n{'z' * i}") for i in range(15)]
    out = linetree.drop_templates(frame(docs), min_docs=min_docs, carry=("key",)).collect()
    assert all(r["key"] == "x" for r in out) and len(out) == len(docs)
    want = plain.without_templates([d for d in docs if d[0] is not None], 3, min_docs, 0.8)
    assert {r["doc_id"]: r["kept"] for r in out if r["doc_id"] is not None} == want
    assert next(r["kept"] for r in out if r["doc_id"] is None) == "page 1 of the common footer line here"
    assert sum(len(r["dropped"]) for r in out) > 20
    assert linetree.drop_templates(frame([])).count() == 0


@pytest.mark.parametrize("n", [100, 2000])
def test_fields_of_many_values_stay_fields(frame, n):
    """Each value of both fields is in 20 of 2,000 texts, which is more than min_docs; another template shares the leaf."""
    value = lambda k: "v" + "abcdefghij"[k % 10] + "abcdefghij"[k // 10]
    line = lambda i: f"this page was last edited by {value(i % 100)} on behalf of {value(i * 7 // 100 % 100)} under the terms of the site"
    docs = [(i, f"{line(i)}\nown {'x' * i}") for i in range(n)]
    docs += [(n + i, f"this page was {' '.join('other' for _ in range(15))}\nmore {'x' * i}") for i in range(12)]
    out = {r["doc_id"]: r["dropped"] for r in linetree.drop_templates(frame(docs)).collect()}
    assert [d for d in sorted(out) if out[d] != [0]] == [0, n]


@pytest.mark.parametrize("n", [40, 400, 3000])
def test_templates_of_a_log_of_any_size(frame, n):
    """Several templates in one leaf, fields of few, many and numeric values, lines of numbers and marks, copies, against the plain rule."""
    r = random.Random(n)
    word = lambda few: "w" + "".join(r.choice("abcdefghij") for _ in range(1 if few else 3))
    kinds = [
        lambda: f"user {word(True)} opened the file {word(False)} on host {r.randint(1, 9)} at {r.randint(0, 23)}:{r.randint(0, 59)}",
        lambda: f"user {word(False)} closed the file {word(False)} on host {word(True)} at night",
        lambda: f"total {r.randint(0, 3)} of {r.randint(0, 3)}", lambda: f"{r.randint(0, 9)} {r.randint(0, 9)}", lambda: "---- <*> ----", lambda: "<*> <*>",
        lambda: " ".join(word(True) for _ in range(r.randint(1, 4))), lambda: "", lambda: "caf\u00e9 \u00e9t\u00e9 au lait chaque matin",
    ]
    docs = [(i, "\n".join(r.choice(kinds)() for _ in range(r.randint(0, 8)))) for i in range(n)]
    docs += [(n + i, docs[i % 7][1]) for i in range(20)]
    for min_docs, similarity in ((10, 0.8), (3, 0.6)):
        out = linetree.drop_templates(frame(docs), min_docs=min_docs, similarity=similarity).collect()
        assert {x["doc_id"]: x["kept"] for x in out} == plain.without_templates(docs, 3, min_docs, similarity)


def test_lines_of_many_numbers_are_templates(frame):
    docs = [(i, f"Version 2.0, January 2004\nPage {i} of 30\n2004 11\n{i} {i + 1}\nown {'x' * i}") for i in range(30)]
    out = linetree.drop_templates(frame(docs)).collect()
    # numbers alone are dropped where they are the same
    assert {r["doc_id"]: r["dropped"] for r in out} == {i: [0, 1, 2] if i else [] for i in range(30)}


def test_labelled_rows_that_share_a_word_are_all_used(spark):
    common = min(("".join(x) for x in itertools.product("abcdefgh", repeat=4)), key=lambda w: zlib.crc32(w.encode()))
    df = spark.createDataFrame([(d, f"{t} {common}", q, x, h, p) for d, t, q, x, h, p in labelled()], "doc_id long, text string, quality int, toxic int, host string, path string")
    out = quality.judge(df, quality.fit(df.where("doc_id % 2 = 0"))).where("doc_id % 2 = 1").select("quality", "toxic", "verdict.keep").collect()
    assert sum(bool(r["quality"] and not r["toxic"]) == r["keep"] for r in out) >= 0.97 * len(out)


def test_near_copies_share_the_weight_of_one_row(spark):
    r = random.Random(3)
    sets = [np.array(r.sample(range(1, 2000), 100), np.uint64) for _ in range(40)]
    near = [np.append(sets[0][:95], np.uint64(5000 + k)) for k in range(20)]
    group = quality.near_copies([*sets, *near, sets[1], np.zeros(0, np.uint64), np.zeros(0, np.uint64)])
    assert len(set(group[:40])) == 40 and set(group[40:60]) == {group[0]} and group[60] == group[1] and group[61] == group[62]
    rows = [(" ".join(r.choice("pqrstuvw") * r.randint(2, 9) for _ in range(50)), 1, 0) for _ in range(60)]
    copies = [(f"{rows[0][0]} mark copy{k}", 0, 1) for k in range(200)]
    fit = lambda rows: quality.fit(spark.createDataFrame(rows, "text string, quality int, toxic int"))
    assert abs(fit(rows + copies).mean - fit(rows + copies[:1]).mean).max() < 0.1


def test_leaks_that_the_space_does_not_show(frame):
    """400 passages in a space of 4 dimensions, each whole or with a fifth of its words replaced inside other words of the benchmark."""
    r = random.Random(6)
    stock = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(900)]
    item = lambda n: [r.choice(stock) for _ in range(n)]
    items = [(i, item(r.choice([5, 12, 30, 60]))) for i in range(400)]
    changed = lambda i, w: ["other" if i % 2 and len(w) >= 8 and k % 5 == 2 else x for k, x in enumerate(w)]
    docs = [(i, " ".join(item(r.randint(0, 90)) + changed(i, w) + item(r.randint(0, 90)))) for i, w in items]
    out = decontaminate.find_leaks(frame(docs), frame([(i, " ".join(w)) for i, w in items], "item_id long, text string"), rank=4, cosine=0.9)
    assert {(i, i) for i, _ in items} == {(x["doc_id"], x["item_id"]) for x in out.collect()}
