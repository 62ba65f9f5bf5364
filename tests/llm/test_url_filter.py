import fnmatch
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from logloom.llm import url_filter as U
from tests.llm.conftest import dicts


def glob_regex(g):
    return re.compile("".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in g), re.S)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab*?", max_size=7), min_size=1, max_size=20),
       st.lists(st.text("ab", max_size=8), min_size=1, max_size=6))
def test_automaton_is_glob_matching(globs, texts):
    got = U.match_all([t.encode() for t in texts], U.compile_globs(globs))
    for i, t in enumerate(texts):
        assert got[i].tolist() == [bool(glob_regex(g).fullmatch(t)) for g in globs]


def brute(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m.group(1), m.group(2)) if m else ("", "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in U.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, rule, verdict = max(fits)
        return host, path, rule, verdict
    hit = any(glob_regex(g).fullmatch(f".{host}#{path}") for g in U.BLOCK_GLOBS)
    return host, path, None, "block" if hit else "allow"


URLS = [None, "", "no scheme", "http://", "http://ORG/", "http://org", "http://a.Example.ORG/es/x?q#f",
        "http://example.org/en/12", "http://example.org/en/2", "http://notexample.org/es/", "http://xorg/",
        "https://com/fr/", "http://x.com/de/y", "http://x.com/de", "http://x.com?a=/de/", "http://x.com#/fr/",
        "http://ads.x.net/", "http://x.net/ads/y", "http://x.net/a.exe", "http://x.net/a.EXE", "://org/",
        "http://ä.org/ü", "a://b://org/", "http://x.net/#org/", "http://x.net/" + "a" * 5000 + ".zip", "http://u\nv.org/x\ny"]


def test_urls_match_brute_force(spark):
    rows = [(i, u, "clash") for i, u in enumerate(URLS)] + [(None, URLS[4], "clash"), (3, URLS[3], "clash")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, host string")
    got = [(r["id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in dicts(U.filter_urls(df))]
    want = [(i, *brute(u)) for i, u, _ in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert U.filter_urls(df.where("page_id < 0")).count() == 0


def test_many_globs_share_words():
    globs = [f"*k{i}k*" for i in range(300)] + ["*"]
    a = U.compile_globs(globs)
    assert a.accept.shape[1] > 20
    hit = U.match_all([b"zzk17kzz", b"k299k", b"k3k4k"], a)
    assert [set(h.nonzero()[0].tolist()) for h in hit] == [{17, 300}, {299, 300}, {3, 4, 300}]
    assert fnmatch.fnmatchcase("k3k4k", "*k4k*")


def test_rules_are_literal_and_can_be_a_table(spark):
    rules = [("block", "a*b.net", "/x?y"), ("allow", "net", "/*/"), ("block", "b.net", "/"), ("allow", None, "/"),
             ("allow", "b.net", "/"), ("block", "net", "")]
    urls = ["http://a*b.net/x", "http://axb.net/x", "http://q.net/*/z", "http://q.net/z/z", "http://b.net/",
            "http://b.org/", "http://[a*b.net/x?y"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    for given_rules in (rules, table):
        got = {r["id"]: (r["rule"], r["verdict"]) for r in dicts(U.filter_urls(df, rules=given_rules, block_globs=()))}
        assert got == {0: ("net", "block"), 1: ("net", "block"), 2: ("net/*/", "allow"), 3: ("net", "block"),
                       4: ("b.net/", "block"), 5: (None, "allow"), 6: ("net", "block")}
    none = U.filter_urls(df, rules=table.limit(0), block_globs=())
    assert {(r["rule"], r["verdict"]) for r in dicts(none)} == {(None, "allow")}


def test_blocks_and_steps_change_nothing():
    patterns = [U.rule_tokens(f"h{i}.com", f"/{i % 7}") for i in range(200)] + [U.glob_tokens("*zz*")]
    texts = [f".x.h{i}.com#/{(i + i // 100) % 7}".encode() for i in range(0, 250, 3)] + [b".zz#", b""]
    want = [next((k for k, p in enumerate(patterns) if re.fullmatch(b"".join(
        b".*" if t == "*" else re.escape(bytes([t])) for t in p), x, re.S)), -1) for x in texts]
    for words, state in ((256, 1 << 20), (1, 64), (3, 1), (10_000, 1 << 20)):
        blocks = U.blocks_of(patterns, words)
        assert [b[0] for b in blocks][0] == 0 and (len(blocks) == 1) == (words == 10_000 or words == 256)
        assert U.first_match(texts, blocks, state).tolist() == want
