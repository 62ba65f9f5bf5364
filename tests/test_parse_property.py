"""The single-pass parser against a backtracking-regex model on random lines.

Python's ``re`` (ASCII mode, ``fullmatch``) backtracks like Java's
``Matcher.matches()``, so for lines without line terminators its groups
are the reference's groups.  Lines are built from fragments that stress
the greedy groups: extra quotes, brackets, spaces and digit runs.
"""

import random
import re
import time

from logloom.functions import parse as P

FRAGMENTS = ['"', " ", "[", "]", "1", "22", "333", "a", "b c", "-", '" "', "] [", '"x"',
             "GET /a HTTP/1.1", "200", "\t", "::", "é"]


def _random_line(rnd: random.Random) -> str:
    if rnd.random() < 0.5:
        # mostly well-formed, with noise inside the free-text groups
        noise = lambda: "".join(rnd.choice(FRAGMENTS) for _ in range(rnd.randint(0, 4)))
        return (f"{rnd.choice(['1.2.3.4', 'x', 'a-b'])} {noise() or 's'} [{noise() or 'd'}] "
                f'"{noise()}" {rnd.choice(["200", "404", "x"])} {rnd.choice(["10", "-", "7"])} '
                f'"{noise()}" "{noise()}"')
    return "".join(rnd.choice(FRAGMENTS) for _ in range(rnd.randint(0, 25)))


def _random_combined_line(rnd: random.Random) -> str:
    if rnd.random() < 0.5:
        noise = lambda: "".join(rnd.choice(FRAGMENTS) for _ in range(rnd.randint(0, 4)))
        target = rnd.choice(["/a", "/a b", '/"q"', "*", "/x?y=1"])
        ref = rnd.choice(["-", "http://h/", "a b", '"'])
        return (f"{rnd.choice(['1.2.3.4', 'x'])} - {noise() or '-'} [{noise() or 'd'}] "
                f'"GET {target} HTTP/1.1" 200 {rnd.choice(["10", "-"])} "{ref}" "{noise() or "m"}"')
    return _random_line(rnd)


def _check(spark, pattern, names, parse_fn, n=400, seed=1, gen=_random_line):
    rnd = random.Random(seed)
    lines = [gen(rnd) for _ in range(n)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, value string")
    got = {r["i"]: tuple(r[c] for c in names) for r in parse_fn(df).collect()}
    rx = re.compile(pattern, re.ASCII)
    matched = 0
    for i, s in enumerate(lines):
        m = rx.fullmatch(s)
        if m is None:
            assert i not in got, s
        else:
            matched += 1
            assert got[i] == m.groups(), (s, got[i], m.groups())
    assert matched > n // 10   # the sample exercises both outcomes


def test_access_log_parser_matches_backtracking_model(spark):
    _check(spark, P.ACCESS_LOG_PATTERN, P.ACCESS_LOG_FIELDS,
           lambda df: P._parse(df, P.ACCESS_LOG_PATTERN, P.ACCESS_LOG_FIELDS, "value", ["i"]))


def test_combined_parser_matches_backtracking_model(spark):
    _check(spark, P.COMBINED_LOG_PATTERN, P.COMBINED_LOG_FIELDS,
           lambda df: P._parse(df, P.COMBINED_LOG_PATTERN, P.COMBINED_LOG_FIELDS, "value", ["i"]),
           seed=2, gen=_random_combined_line)


def test_strict_parser_matches_backtracking_model(spark):
    def line(rnd):
        if rnd.random() < 0.2:
            return _random_line(rnd)
        noise = lambda: "".join(rnd.choice(FRAGMENTS) for _ in range(rnd.randint(0, 4)))
        request = rnd.choice(["GET /a HTTP/1.1", 'a] "b c', '"x" y z', "GET /a", "a b c d", '] "x] "y'])
        return (f'1.2.3.4 {rnd.choice(["s", "s", "s", "a b", "]"])} [{noise() or "d"}] "{request}" 200 '
                f'{rnd.choice(["1", "1", "-"])} "{rnd.choice(["-", "h", "a b", "h"])}" "{noise() or "m"}"')
    _check(spark, P.WEBLOG_STRICT_PATTERN, P.WEBLOG_FIELDS,
           lambda df: P._parse(df, P.WEBLOG_STRICT_PATTERN, P.WEBLOG_FIELDS, "value", ["i"]),
           seed=3, gen=line)


def _delimiters(rnd: random.Random) -> str:
    """Lines of hardly anything but delimiters, which overlap and repeat."""
    parts = ['" "', '] "', " [", '" 1 2 "', '"', " ", "[", "]", " 1", "x", '" 3', "\t"]
    body = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30)))
    tail = rnd.choice(['" 1 2 "r" "a"', '" 1 2 "" ""', '" 1 2 " " "" "', "", '"'])
    return rnd.choice(["ip s", "ip ", "ip"]) + rnd.choice([" [d] \"", " [", ""]) + body + tail


def test_parsers_settle_repeated_delimiters_as_the_patterns_do(spark):
    for pattern, names in ((P.ACCESS_LOG_PATTERN, P.ACCESS_LOG_FIELDS),
                           (P.COMBINED_LOG_PATTERN, P.COMBINED_LOG_FIELDS),
                           (P.WEBLOG_STRICT_PATTERN, P.WEBLOG_FIELDS)):
        rnd = random.Random(11)
        lines = [_delimiters(rnd) for _ in range(3000)]
        df = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
        got = {r["i"]: tuple(r[c] for c in names) for r in P._parse(df, pattern, names, "value", ["i"]).collect()}
        rx = re.compile(pattern, re.ASCII)
        want = {i: m.groups() for i, s in enumerate(lines) if (m := rx.fullmatch(s))}
        assert got == want
        assert want or pattern != P.ACCESS_LOG_PATTERN


def test_line_terminators_match_no_dot(spark):
    line = 'ip s [d] "GET / H" 200 1 "r" "a"'
    dot = "[^\\n\\r\\u0085\\u2028\\u2029]"
    bad = [line.replace(x, x + t) for x in ("s", "d", "/", "r", "a") for t in ("\r", "\n", "\u2028", "\u0085")]
    df = spark.createDataFrame(list(enumerate([line, *bad, "ip\u2028x" + line[2:]])), "i int, value string")
    for pattern, names in ((P.ACCESS_LOG_PATTERN, P.ACCESS_LOG_FIELDS), (P.COMBINED_LOG_PATTERN, P.COMBINED_LOG_FIELDS),
                           (P.WEBLOG_STRICT_PATTERN, P.WEBLOG_FIELDS)):
        rx = re.compile(pattern.replace(".", dot), re.ASCII)
        want = {r["i"]: m.groups() for r in df.collect() if (m := rx.fullmatch(r["value"]))}
        got = {r["i"]: tuple(r[c] for c in names) for r in P._parse(df, pattern, names, "value", ["i"]).collect()}
        assert got == want and {0, len(bad) + 1} <= set(want) and len(want) < len(bad)


def test_near_misses_of_a_megabyte_take_no_longer_than_a_scan(spark):
    n = 1 << 20
    lines = ['ip s [' + 'd] "' * (n // 4) + 'x"', 'ip s' + ' [d] "' * (n // 6) + '" 1 2 "r"',
             'ip' + ' [' * (n // 2) + '"', 'ip s [d] "' + '" 1 2 ' * (n // 6) + '"',
             'ip s [d] "a b c" 1 2 "' + '" ' * (n // 2) + 'x"', 'ip s [d] "' + "1" * n + '" 1 2 "',
             'ip s [d] "a b c" ' + "1" * n + ' 2 "r" "', 'ip s ' + '[d] "a b c" 1 2 "r' * (n // 18) + '"']
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string").repartition(8, "i").cache()
    df.count()
    for pattern, names in ((P.ACCESS_LOG_PATTERN, P.ACCESS_LOG_FIELDS),
                           (P.COMBINED_LOG_PATTERN, P.COMBINED_LOG_FIELDS),
                           (P.WEBLOG_STRICT_PATTERN, P.WEBLOG_FIELDS)):
        P._parse(df.limit(1), pattern, names, "value").count()  # code is compiled
        t0 = time.perf_counter()
        P._parse(df, pattern, names, "value").write.format("noop").mode("overwrite").save()
        assert time.perf_counter() - t0 < 8  # one second a line
    df.unpersist()
