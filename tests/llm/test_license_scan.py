import random

import regex

from logloom.llm import license_scan as L
from tests.llm.conftest import EDGE, dicts


def scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["id"]: r for r in dicts(L.scan_licenses(df))}


def test_variants_of_a_licence_text_are_one_digest(spark):
    mit = L._MIT
    found = scan(spark, [
        mit, "Copyright (c) 2020 Some Body\n\n" + mit.replace("copyright", "COPYRIGHT"),
        "Copyright 2019-2021 A. Nother. All rights reserved.\n" + mit.replace("\n", "\r\n"),
        mit.replace("sublicense", "sub-licence").replace('"', "''"), mit + " And more.", mit[:-10]])
    assert [found[i]["whole"] for i in range(6)] == ["MIT"] * 4 + [None] * 2
    assert len({found[i]["text_sha256"] for i in range(4)}) == 1


def test_notices_inside_documents(spark):
    found = scan(spark, [
        "Some prose.\nReleased under the MIT License.\nMore prose.",
        "prose\n\n  * licensed under the Apache Licence, version 2.0\n\nLicensed under CC BY-NC 4.0.\nx",
        "We do not say: released under the MIT License, do we?",
        "Released under the MIT License.\nreleased under the MIT licence\n", L._ISC.replace("\n\n", "\n\n\n")])
    assert [found[i]["licenses"] for i in range(5)] == ["MIT", "Apache-2.0,CC-BY-NC-4.0", "", "MIT", "ISC"]
    assert [found[i]["n_units"] for i in range(5)] == [1, 2, 0, 1, 1]


def test_whole_texts_and_headers_with_and_without_other_text(spark):
    known = L.published_texts()
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0",
            "MPL-2.0", "Unlicense", "CC0-1.0"} <= {i for i, _ in known}
    texts = known + [(i, t) for i, t in L.KNOWN[:6]]
    found = scan(spark, [t for _, t in texts] + [f"int main;\n\n{t}\n\nThe code goes on.\n\nx" for _, t in texts])
    for n, (i, t) in enumerate(texts):
        assert found[n]["whole"] == i and found[n + len(texts)]["whole"] is None
        assert i in found[n + len(texts)]["licenses"].split(","), (i, t[:40])
    # a text that ends inside a paragraph is not it; the list can be a table
    cut = scan(spark, [L._ZLIB + " And more.", "x " + L._ZLIB])
    assert all(r["licenses"] == "" for r in cut.values())
    table = spark.createDataFrame([("Own", "One\n\nTwo words.")], "license string, text string")
    docs = spark.createDataFrame([(1, "a\n\none\n\n\ntwo WORDS\n\nb"), (2, "one two words"), (3, "one two")], "doc_id int, text string")
    assert {r["id"]: r["licenses"] for r in dicts(L.scan_licenses(docs, known=table))} == {1: "Own", 2: "Own", 3: ""}


def test_edge_rows(edge, empty):
    found = dicts(L.scan_licenses(edge))
    assert len(found) == len(EDGE)
    assert all(r["licenses"] == "" and r["whole"] is None for r in found)
    assert len({r["text_sha256"] for r in found if r["id"] in (2, 3, 7)}) == 1
    assert L.scan_licenses(empty).count() == 0


def test_known_texts_have_distinct_digests_per_licence(spark):
    table = L.known_digests(spark)
    owner = {}
    for lic, digest, _ in table:
        assert owner.setdefault(digest, lic) == lic


def brute(text, known):
    """Whole text, lines and all runs of paragraphs, compared as texts."""
    t = (text or "").replace("\r\n", "\n").replace("\r", "\n").lower()
    for a, b in L.EQUIVALENT:
        t = t.replace(a, b)
    t = regex.sub(L.COPYRIGHT_LINE.replace(r"\z", r"\Z"), "", t)
    t = regex.sub(L.NOT_WORD, " ", t)

    def one(x):
        return regex.sub(r"[ \n]+", " ", x).strip(" ")
    whole = one(t)
    paragraphs = [p for p in map(one, regex.split(r"\n[ \n]*\n", t)) if p]
    units = {whole} | {one(x) for x in t.split("\n")}
    units |= {" ".join(paragraphs[i:j]) for i in range(len(paragraphs)) for j in range(i + 1, len(paragraphs) + 1)}
    found = {u for u in units if u in known}
    return (max(known[whole]) if whole in known else None,
            ",".join(sorted({x for u in found for x in known[u]})), sum(len(known[u]) for u in found))


def test_runs_of_paragraphs_against_brute_force(spark):
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "sub-licence", "Copyright 2020 X"]

    def paragraph():
        return " ".join(rng.choices(words[:5], k=rng.randint(1, 4)))
    given = [(f"L{i}", "\n\n".join(paragraph() for _ in range(rng.randint(1, 4)))) for i in range(25)]
    given += [("Same", given[0][1].upper()), ("Null", None), ("Empty", " ,. "), (None, "alpha beta")]
    texts = [None, "", "\n\n"]
    for _ in range(150):
        parts = [rng.choice([t for _, t in given[:25]]) if rng.random() < .4 else paragraph()
                 for _ in range(rng.randint(1, 6))]
        texts.append(rng.choice(["\n\n", "\n \n\n", "\n"]).join(parts) + rng.choice(["", "\n", "\n\nx", "\n" + words[5]]))
    texts.append("\n\n".join(paragraph() for _ in range(1500)))
    table = spark.createDataFrame(given, "license string, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    known = {}
    for i, t in given:
        c = brute_canonical(spark, t)
        if i and c:
            known.setdefault(c, set()).add(i)
    got = {r["id"]: (r["whole"], r["licenses"], r["n_units"]) for r in dicts(L.scan_licenses(docs, known=table))}
    want = {i: brute(t, known) for i, t in enumerate(texts[:-1])}
    assert {i: got[i] for i in want} == want
    assert any(w[2] for w in want.values()) and any(w[0] for w in want.values())
    assert len(got) == len(texts)
    none = dicts(L.scan_licenses(docs, known=table.limit(0)))
    assert len(none) == len(texts) and all(r["licenses"] == "" for r in none)


def brute_canonical(spark, text):
    from pyspark.sql import functions as F
    return spark.range(1).select(L.canonical(F.lit(text).cast("string")).alias("c")).first()["c"]


def test_running_ends(spark):
    from pyspark.sql import functions as F
    for n in (0, 1, 255, 256, 257, 1000):
        xs = [i % 7 for i in range(n)]
        row = spark.createDataFrame([(xs,)], "xs array<int>").select(L.running_ends(F.col("xs")).alias("e")).first()
        assert list(row["e"]) == [sum(xs[:i]) for i in range(n + 1)]
