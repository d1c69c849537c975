"""Near duplicates, fingerprints, contamination, quality and licences against plain versions."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from doclake.llm import decontaminate, fingerprints, licenses, minmax_dedup, quality
from tests.conftest import rows


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def plain_components(docs, size, percent):
    sets = [shingles(t, size) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    lowest = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            lowest[root(i)] = min(d, lowest.get(root(i), d))
    return sorted(((d, len(sets[i]), lowest.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)), key=repr)


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice("the of and to in is".split())
    return " ".join(words)


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, odd_docs, size, percent):
    rng = random.Random(size)
    base = [f"w{rng.randrange(400)}" for _ in range(150)]
    group = [edited(base, k % 9, rng) for k in range(70)]  # similarities on both sides of the threshold
    chain = [" ".join(f"c{i}" for i in range(k, k + 100)) for k in range(0, 60, 3)]  # each alike only its neighbours
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    docs += [(100 + i, t) for i, t in enumerate([*group, *group[:20], *chain])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("node", F.lit("x"))
    got = minmax_dedup.near_duplicates(df, size, percent)
    assert rows(got.select("doc_id", "n_shingles", "component_id")) == plain_components(docs, size, percent)
    assert got.filter("kept <> (doc_id <=> component_id)").count() == 0
    assert minmax_dedup.near_duplicates(df.limit(0), size, percent).count() == 0


def test_divided_buckets_are_finished(spark, monkeypatch):
    """With one hub per bucket much is left apart; the blocks find it, however small they are."""
    monkeypatch.setattr(minmax_dedup, "_BLOCK", 3)
    rng = random.Random(2)
    base = [f"w{rng.randrange(300)}" for _ in range(80)]
    docs = [(i, edited(base, 1 + i % 6, rng)) for i in range(60)]
    got = minmax_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 3, 85)
    assert rows(got.select("doc_id", "n_shingles", "component_id")) == plain_components(docs, 3, 85)


def test_strays_in_large_buckets(spark, monkeypatch):
    """Many linked texts and few that meet them in buckets alone: no task takes a whole bucket."""
    taken = []
    confirmed = minmax_dedup._confirmed
    monkeypatch.setattr(minmax_dedup, "_confirmed", lambda texts, units, *a: (taken.append(units), confirmed(texts, units, *a))[1])
    monkeypatch.setattr(minmax_dedup, "_ROWS", 50)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    docs = [(i, edited(base, 1 + i % 3, rng)) for i in range(600)] + [(1000 + i, edited(base, 14 + i, rng)) for i in range(6)]
    got = minmax_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 3, 85)
    assert rows(got.select("doc_id", "n_shingles", "component_id")) == plain_components(docs, 3, 85)
    for units in taken[1:]:
        groups = units.groupBy("unit", "part").agg(F.count_if(F.col("role") == 1).alias("n")).agg(F.max("n")).first()[0]
        assert groups is None or groups < 120


def test_many_texts_without_id(spark):
    base = " ".join(f"w{i}" for i in range(60))
    docs = [(None, f"{base} number {i % 700} of them") for i in range(1400)] + [(5, f"{base} number 3 of them"), (6, "alone"), (6, "quite alone"), (None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = minmax_dedup.near_duplicates(df, 3, 85)
    found = {(r["doc_id"], r["component_id"], r["kept"]): r["n"] for r in got.groupBy("doc_id", "component_id", "kept").agg(F.count("*").alias("n")).collect()}
    assert found == {(None, 5, False): 1400, (5, 5, True): 1, (6, 6, True): 2, (None, None, True): 1}


def test_fingerprints(spark, odd_docs, no_docs):
    got = fingerprints.compare_with_next(odd_docs, parts=3)
    plain = [((r["doc_id"]), r["text"] or "") for r in odd_docs.collect()]
    assert got.count() == len(plain) and got.filter("near_edited < 0 or near_edited > 1 or near_next < 0 or near_next > 1").count() == 0
    by = {r["doc_id"]: r for r in got.collect() if r["doc_id"] in (3, 5, 7, 8, 9)}
    text = dict((i, t) for i, t in plain if i in (2, 3, 4, 5, 7, 8, 9))
    for here, following in ((9, 8), (8, 7), (7, 5), (5, 4), (4, 3), (3, 2)):
        if here in by:
            half = len(text[here]) // 2
            want = text[here][: len(text[here]) - half] + text[following][:half]
            assert by[here]["edited_sha256"] == hashlib.sha256(want.encode()).hexdigest() and by[here]["n_chars"] == len(text[here])
    assert by[8]["near_next"] > 0.95 and by[3]["fingerprint"] == ""
    signed = fingerprints.fingerprints(odd_docs)
    assert signed.columns == [*odd_docs.columns, "fingerprint"] and signed.filter("doc_id = 7").first()["fingerprint"] == by[7]["fingerprint"]
    assert signed.filter("text like 'alpha%'").select("fingerprint").distinct().count() == 1
    assert fingerprints.compare_with_next(no_docs).count() == 0
    one = fingerprints.compare_with_next(odd_docs.filter("doc_id = 5"), parts=4).first()
    assert one["near_next"] == 1.0


def test_likeness_is_unbiased():
    method, rng = fingerprints.Fingerprinter(), random.Random(4)
    gaps = []
    for k in range(40):
        base = [f"w{rng.randrange(5000)}" for _ in range(20 + 15 * k)]
        a, b = " ".join(base), edited(base, 1 + k % 7, rng)
        values = [method.bin_values(w) for w in fingerprints.word_hashes(fingerprints.pa.array([a, b]))]
        assert np.array_equal(method.unpacked(method.packed(values[0])), values[0])
        gaps.append(method.likeness(*values) - jaccard(shingles(a, 5), shingles(b, 5)))
    assert abs(np.mean(gaps)) < 0.02 and max(map(abs, gaps)) < 0.15


def plain_contamination(docs, items, window=13):
    between = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: [w for w in between.split((t or "").translate(fold)) if w]
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for i, it in items:
            v = words(it)
            k = min(len(v), window)
            wanted = {tuple(v[j : j + k]) for j in range(len(v) - k + 1)} if v else set()
            for j in range(len(w) - k + 1 if k else 0):
                if tuple(w[j : j + k]) in wanted:
                    hit.update(range(j, j + k))
                    found.add("" if i is None else str(i))
        out.append((d, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def test_contamination(spark, odd_docs, no_docs):
    rng = random.Random(9)
    item = [f"b{rng.randrange(30)}" for _ in range(40)]
    items = [(1, " ".join(item)), (2, "Short ITEM here"), (3, None), (4, "..."), (None, " ".join(item[5:30])), (12, " ".join(item)), (12, " ".join(item))]
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    docs += [
        (20, "x " * 50 + " ".join(item[3:20]).upper() + ", and so on"),
        (21, " ".join(item[3:15])),
        (22, "a short item Here. short item"),
        (23, " ".join([*item, *item]) + " z" * 900),
        (24, "É" + " ".join(item[:13]) + " ÉTÉ"),
        (25, "-- " + " ".join(item[27:40]) + " --"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("found", F.lit(1)).withColumn("mark", F.lit(2))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for lists in (1, 2, 4):
        got = decontaminate.contamination(df, bench, lists=lists)
        assert rows(got) == plain_contamination(docs, items)
    kept = decontaminate.contamination(df, bench, keep=True)
    assert kept.columns == [*df.columns, "n_words", "n_hit", "items", "contaminated"] and kept.count() == len(docs)
    assert decontaminate.contamination(no_docs, bench).count() == 0
    assert decontaminate.contamination(df, bench.limit(0)).filter("contaminated or n_hit > 0").count() == 0


def test_contamination_with_clashing_columns(spark):
    item = " ".join(f"b{i}" for i in range(20))
    docs = spark.createDataFrame([(1, item, 7, "x"), (2, "clean text", 8, None), (2, "clean text", 8, None)], "doc_id long, text string, n_words int, _id string")
    for c in ("_mark", "items", "_items", "n_hit", "contaminated", "row", "mark", "key", "found", "words"):
        docs = docs.withColumn(c, F.lit(c))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = decontaminate.contamination(docs, bench, keep=True)
    assert sorted(found.columns) == sorted(docs.columns) and [r["n_hit"] for r in found.orderBy("doc_id").collect()] == [20, 0, 0]
    assert rows(decontaminate.without_contaminated(docs, bench)) == rows(docs.filter("doc_id = 2"))


def test_very_long_benchmark_items(spark):
    long = [f"t{i * 7919 % 30011}" for i in range(50_000)]
    docs = [(1, "some words " + " ".join(long[20_000:20_030]) + " and more"), (2, " ".join(long)), (3, " ".join(long[::-1][:40]))]
    bench = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(long[:15]))], "item_id long, text string")
    got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), bench)
    found = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in got.collect()}
    assert found == {1: (34, 30, ["1"]), 2: (50_000, 50_000, ["1", "2"]), 3: (40, 0, [])}


def test_phrases_within_a_width(spark):
    docs = spark.createDataFrame([(1, "red x x blue x x green red blue"), (2, "red blue"), (3, "green " + "x " * 20 + "red blue")], "doc_id long, text string")
    queries = spark.createDataFrame([("q", "red"), ("q", "blue"), ("q", "green"), ("r", "nowhere"), ("r", "red")], "query string, term string")
    index = decontaminate.postings(docs, queries.select("term").distinct(), small=True)
    got = decontaminate.near_matches(index, queries, 7).select("query", "doc_id", "first", "last")
    assert rows(got) == [("q", 1, 0, 6), ("q", 1, 3, 7), ("q", 1, 6, 8)]


def test_quality(spark, odd_docs, no_docs):
    rng = random.Random(3)
    good = [(i, " ".join(rng.choice("the of and quite plain words here".split()) for _ in range(60)) + ".", 1) for i in range(100, 160)]
    bad = [(i, " ".join(rng.choice("BUY!! NOW!! $$$ ###".split()) for _ in range(60)), 0) for i in range(160, 220)]
    data = spark.createDataFrame([*good, *bad], "doc_id long, text string, quality int")
    ranker = quality.train(data, data.select("doc_id", "quality"))
    got = quality.score_quality(data, ranker)
    assert got.filter("predicted <> quality").count() == 0 and got.filter("score < 0 or score > 1").count() == 0
    odd = quality.score_quality(odd_docs, ranker)
    assert odd.count() == odd_docs.count() and odd.filter("score is null").count() == 0 and set(odd.columns) == {*odd_docs.columns, "predicted"}
    assert quality.score_quality(no_docs, ranker).count() == 0
    none = data.select("doc_id", F.lit(None).cast("int").alias("quality"))
    assert quality.train(data, none) is None and quality.score_quality(data, None).filter("score <> 0.5").count() == 0
    # Marks of held-out rows change nothing.
    flipped = data.select("doc_id", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")).alias("quality"))
    assert np.array_equal(quality.train(data, flipped).weights, ranker.weights)


def test_licenses(spark, odd_docs, no_docs):
    rng = random.Random(6)
    plain = lambda n: " ".join(rng.choice("the of and to in is for by with on that".split()) + rng.choice(["", "s", "ing"]) for _ in range(n))
    cases = {
        "mit": f"{plain(40)}\nReleased under the MIT License.\n{plain(30)}",
        "apache": f"Licensed under the Apache License, Version 2.0.\n{plain(50)}",
        "gpl": f"{plain(9)}\nThis work is licensed under the GNU General Public License, version 3.",
        "cc": f"{plain(9)}\nLicensed under CC BY-NC 4.0.\n\n",
        "": f"{plain(20)}\nHer driving license came on Monday.\n{plain(20)}",
    }
    texts = [(i, t) for i, t in enumerate(cases.values())] + [(100 + i, plain(60)) for i in range(120)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    model = licenses.train(docs)
    got = {r["doc_id"]: r["families"] for r in licenses.license_documents(docs, model).collect()}
    assert {i: got[i] for i in range(len(cases))} == dict(enumerate(cases)) and all(got[100 + i] == "" for i in range(120))
    odd = licenses.license_documents(odd_docs, model)
    assert odd.count() == odd_docs.count() and odd.filter("families <> ''").count() == 0
    assert licenses.license_documents(no_docs, model).count() == 0


def test_frequent_licence_notices_are_found(spark):
    """Notices that differ per file, in a third of the lines and in all of them."""
    rng = random.Random(8)
    plain = lambda: " ".join(rng.choice("river walked seven under houses green slowly the of and to".split()) + rng.choice(["", "s", "ing"]) for _ in range(20))
    notices = [(i, f"Copyright {1980 + i % 40} Holder{i}. Licensed under the MIT License") for i in range(300)]
    for others in (600, 0):
        docs = spark.createDataFrame(notices + [(1000 + i, plain()) for i in range(others)], "doc_id long, text string")
        model = licenses.train(docs)
        assert licenses.NAMES <= set(model.words) and not licenses.STOPS & set(model.words)
        got = {r["doc_id"]: r["families"] for r in licenses.license_documents(docs, model).collect()}
        assert [got[i] for i, _ in notices] == ["mit"] * len(notices) and all(got[1000 + i] == "" for i in range(others))


def plain_paragraphs(text):
    """Lines by paragraph, by a loop: comment signs go; six words and no end of a sentence run on in a line that is not blank."""
    signs = re.compile(r"[ \t]*(//+[/!]*|/\*+!?|\*+/?|#+|--+|;+|%+|>+|<!--|(rem|dnl)(?=[ \t]))[ \t]*", re.I)
    lines = [line[m.end() :] if (m := signs.match(line)) else line for line in text.split("\n")]
    lines = [line.rstrip(" \t\r") for line in lines[:-1]] + lines[-1:]
    out, going = [], False
    for line in lines:
        if going and line.strip():
            out[-1].append(line)
        else:
            out.append([line])
        going = len(line.split()) >= 6 and line[-1] not in ".!?:;"
    return out


def plain_licenses(docs, model, least=0.5, alike=0.5, shared=3):
    marked = set(model.words)

    def grams(text):
        w = re.findall(r"[^\W_]+", text.lower())
        return {" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1) if marked & set(w[i : i + n])}

    templates = {f: [grams(t) for t in group] for f, group in licenses.TEMPLATES.items()}
    out = []
    for d, text in docs:
        families, counts = set(), [0, 0, 0]
        for paragraph in plain_paragraphs(text):
            best, whole = 0, None
            for k, unit in enumerate([" ".join(paragraph), *(paragraph if len(paragraph) > 1 else [])]):
                mine = grams(unit)
                if not mine:
                    continue
                raw = (np.array(model.bias) + sum(np.array(model.weights.get(g, [0.0] * len(licenses.FAMILIES))) for g in mine)) / model.temperature
                shares = np.exp(raw - raw.max()) / np.exp(raw - raw.max()).sum()
                family = licenses.FAMILIES[int(shares.argmax())] if shares.max() >= least else licenses.UNKNOWN
                if family == licenses.UNKNOWN:
                    best = max(best, 1)
                    continue
                like = {f for f, ts in templates.items() if any(len(mine & t) >= max(min(shared, len(t)), alike * min(len(mine), len(t))) for t in ts)}
                if family in like:
                    whole = family if k == 0 else whole
                    if whole in (None, family) or whole not in like:
                        families.add(family)
                    best = 3
                else:
                    best = max(best, 2)
            if best:
                counts[3 - best] += 1
        out.append((d, ",".join(sorted(families)), *counts))
    return sorted(out)


def test_short_wrapped_and_reworded_notices(spark):
    short = {
        "License: MIT": "mit", '"license": "MIT",': "mit", 'license = "MIT"': "mit", "MIT licensed": "mit", "License: BSD": "bsd",
        "license: Apache-2.0": "apache", "GPL licensed": "gpl", "License: LGPL": "lgpl", "license = MPL-2.0": "mpl", "License: CC0": "public_domain",
    }
    more = [
        "Licensed under the Apache License,\nVersion 2.0 (the License); you may not use this\nfile except in compliance with the License.",
        "Permission is hereby granted, free of\ncharge, to any person obtaining a copy",
        "The whole of this package may be used under the terms of the MIT license, as its authors wish.",
        "We release all our code under the GNU General Public License, version 3", "MIT licensed the invention to a company in Boston.",
        "Her driving license came on Monday.", "MIT", "License", "the of and to", "",
    ]
    rng = random.Random(5)
    prose = [" ".join(rng.choice("river walked seven houses green slowly the of and to".split()) for _ in range(30)) for _ in range(100)]
    docs = list(enumerate([*short, *more, *prose]))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = licenses.train(df)
    got = sorted(rows(licenses.license_documents(df, model)))
    assert got == plain_licenses(docs, model)
    assert [r[1] for r in got[: len(short)]] == list(short.values())
    assert [r[1] for r in got[len(short) + 4 : len(short) + 8]] == ["", "", "", ""]


def test_wrapped_commented_and_further_licences(spark):
    """Whole notices wrapped at several widths, as comments of several languages, with the family each must give."""
    import textwrap

    affero = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    notices = {
        "mit": licenses.TEMPLATES["mit"][1], "apache": licenses.TEMPLATES["apache"][1], "agpl": affero, "gpl": affero.replace("Affero ", ""),
        "isc": licenses.TEMPLATES["isc"][1], "epl": licenses.TEMPLATES["epl"][1], "boost": licenses.TEMPLATES["boost"][1],
        "artistic": licenses.TEMPLATES["artistic"][1], "mpl": licenses.TEMPLATES["mpl"][1],
    }
    short = {
        "GNU Affero General Public License, version 3": "agpl", "SPDX-License-Identifier: AGPL-3.0": "agpl", "SPDX-License-Identifier: ISC": "isc",
        "License: EPL-2.0": "epl", "SPDX-License-Identifier: BSL-1.0": "boost", "License: Artistic-2.0": "artistic", "License: EUPL-1.2": "eupl",
        "Our code is released under the MIT License\nOur handbook is licensed under CC BY 4.0\nThank you": "cc,mit", "License: WTFPL": "wtfpl", "# License: MIT": "mit", "License: MIT\nLicense: Apache-2.0\n": "apache,mit", "SPDX-License-Identifier: GPL-3.0-only": "gpl",
    }
    cases = list(short.items())
    for family, notice in notices.items():
        for width in (50, 72):
            wrapped = textwrap.wrap(notice, width)
            cases += [("\n".join(wrapped), family), ("\r\n".join(f" * {w}" for w in wrapped), family), ("import x\n\n" + "\n".join(f"# {w}" for w in wrapped) + "\n\nx = 1", family)]
        cases.append(("/*\n" + "\n".join(f"// {w}  " for w in textwrap.wrap(notice, 60)) + "\n*/", family))
    rng = random.Random(7)
    words = "river walked public general seven terms houses free green version slowly the of and to software under work".split()
    prose = [" ".join(rng.choice(words) for _ in range(14)) + rng.choice([".", ""]) for _ in range(400)]
    texts = ["\n".join(prose[i : i + 4]) for i in range(0, 400, 4)]
    docs = list(enumerate([c for c, _ in cases] + texts))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = licenses.train(df)
    got = sorted(rows(licenses.license_documents(df, model)))
    assert got == plain_licenses(docs, model)
    wrong = [(cases[i], got[i]) for i in range(len(cases)) if got[i][1] != cases[i][1]]
    assert not wrong, wrong
    assert sum(r[1] != "" for r in got[len(cases) :]) == 0
