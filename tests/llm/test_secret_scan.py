import re

from hypothesis import given, settings
from hypothesis import strategies as st

from logloom.llm import secret_scan as S
from logloom.llm.common import with_row_id
from tests.llm.conftest import EDGE, dicts, table

HEX = "0123456789abcdef" * 2


def brute(text):
    out = []
    for rank, r in enumerate(S.RULES):
        for m in re.finditer(r.regex, text or "", re.ASCII):
            if len(m.group(r.group)) >= max(1, r.least):
                out.append((m.start(), rank, m.end(), r.kind))
    return sorted(out)


TEXTS = [
    "password=abcdef and PassWord : 'x1/+=_.-' end", "secret: tok; token = abcde", "token==abc12",
    "password: token: abcdefgh", "api_key=\"abcdefg\" APIKEY=1234567 api-key=1234567",
    "AKIA" + "A1" * 8, "AKIA" + "A1" * 7 + "A", "xAKIAAKIA" + "B" * 20, HEX, HEX[:23], "0" * 24 + "G" + "f" * 30,
    "😀é password=ünïcode secret=sécret12 token=abcdef😀" + HEX, "ghp_" + "a" * 36, "xoxb-12345-abcdef",
    "AIza" + "b" * 35, "sk_live_" + "c" * 24, "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSM", "gHp_" + "a" * 36,
    "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----", "-----BEGIN PUBLIC KEY-----",
    "passwd=a\npasswd=\nsecret='''abcdef'", "token=abcdef" * 50, None, "",
]


def test_spans_match_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    got = {r["id"]: [(s["start"], s["rank"], s["end"], s["kind"]) for s in r["spans"]]
           for r in dicts(S.scan_secrets(docs))}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_whole_table_matches_brute_force(spark):
    docs = table(spark, "documents")
    got = {r["id"]: [(s["start"], s["rank"], s["end"], s["kind"]) for s in r["spans"]]
           for r in dicts(S.scan_secrets(docs))}
    assert got == {r.doc_id: brute(r.text) for r in docs.collect()}


def test_queries_say_what_a_match_must_hold():
    assert S.trigram_query("abcd") == [frozenset({"abc", "bcd"})]
    assert S.trigram_query("(?:abc|bcd)x*") == [frozenset({"abc"}), frozenset({"bcd"})]
    assert S.trigram_query("[0-9]+") == S.trigram_query("ab.cd") == S.trigram_query("abc|d") == []
    assert S.trigram_query("ab?cd") == [frozenset({"abc", "bcd"}), frozenset({"acd"})]
    assert S.trigram_query("AB[cd]e+fgh") == [frozenset({"abc", "fgh"}), frozenset({"abd", "fgh"})]


@settings(max_examples=200, deadline=None)
@given(st.sampled_from([r"a(bc|cd)+d", r"ab?c[de]f", r"(ab|a|abc)cd{2}", r"x?abc", r"(?i:ab)c\x20*d",
                        r"a.bcd", r"(abc){2,3}", r"a(b|)cd"]),
       st.text("abcdefx D", max_size=14))
def test_every_match_satisfies_its_query(regex, text):
    m = re.search(regex, text)
    q = S.trigram_query(regex)
    if m and q:
        have = {m.group().lower()[i:i + 3] for i in range(len(m.group()))}
        assert any(c <= have for c in q)


def test_only_rows_with_all_trigrams_are_candidates(spark):
    docs = spark.createDataFrame([(0, "akia"), (1, "aki kia"), (2, "aki"), (3, "none")],
                                 "doc_id bigint, text string").coalesce(1)
    found = S.candidates(with_row_id(docs, "doc_id", "text"), [S.RULES[1]]).collect()
    assert len(found) == 1 and found[0].rows_access[0] == 0b11 and not any(found[0].rows_access[1:])


def test_edge_rows(edge, empty):
    assert S.scan_secrets(edge).count() == len(EDGE)
    assert S.scan_secrets(empty).count() == 0
