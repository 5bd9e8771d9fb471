"""The secret scan against plain searches, and its trigram queries."""

import hashlib
import itertools
import random
import re

import pytest

from riskloom.llm import secretscan
from riskloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, secrets string, kind string, _key long"

BASE = [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, re.I | re.A),
        ("access", "AKIA[A-Z0-9]+", 0, 18, 0), ("hex", "[0-9a-f]+", 0, 16, 0)]
MORE = [(r.kind, r.pattern, r.group, r.shortest, 0) for r in secretscan.RULES[3:]]


def spans(text, rules):
    found = [(m.start(), n, f"{kind}:{m.start()}:{m.end()}") for n, (kind, pattern, group, least, flags) in enumerate(rules)
             for m in re.finditer(pattern, text or "", flags) if len(m[group]) >= least]
    return [s for _, _, s in sorted(found)]


def digest(text):
    found = spans(text, BASE)
    counts = [sum(s.startswith(kind) for s in found) for kind, *_ in BASE]
    return (*counts, hashlib.sha256(",".join(found).encode()).hexdigest(), ",".join(spans(text, BASE + MORE)))


def test_query_against_plain_search(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op13_secret_scan"](spark, SMALL).collect()}
    assert got == {r.doc_id: digest(r.text) for r in docs} and any(v[2] for v in got.values())


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(9)
    key = "".join(rng.choice("0123456789abcdef") for _ in range(40))
    words = ["token", "=", ":", " ", '"', "secret", "PassWord", "api_key", "APIKEY", "passwd", key, "AKIA" + "Z9" * 8, "AKIA", "é", "\U0001f600",
             "abcdefghijklmnop", "hunter2", "ghp_" + key, "xoxb-" + key, "AIza" + "x" * 35, "sk_live_" + key, "\n", "ſecret=" + key, "toKen=" + key,
             "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl", "-----BEGIN RSA PRIVATE KEY-----"]
    texts = ["".join(rng.choice(words) for _ in range(rng.randrange(30))) for _ in range(300)]
    texts += [None, "", " ", "token=secret:abcdefghijklmnop", "token==abcdefghijklm", "é" * 30 + "token = 'é" + key, "AKIAAKIA" + "B" * 20,
              "x " * 20000 + "password: 'correcthorsebattery'", " ".join(f"token={key}" for _ in range(3000)), "f" * 50000]
    return [(i, t, "x", "k", 1) for i, t in enumerate(texts)] + [(None, texts[0], None, None, None), (5, texts[5], "x", "k", 1),
                                                                 (5, texts[5], "x", "k", 1), (None, None, None, None, None)]


def test_odd_rows_against_plain_search(make, odd):
    got = secretscan.find_secrets(make(SCHEMA, odd).repartition(3), ["doc_id", "_key", "text", "secrets"])
    assert got.columns == ["doc_id", "_key", "text", "secrets"]
    rows = [(r.doc_id, r.text, [f"{s.kind}:{s.start}:{s.end}" for s in r.secrets]) for r in got.collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    assert sorted(rows, key=order) == sorted(((i, t, spans(t, BASE + MORE)) for i, t, *_ in odd), key=order)
    assert secretscan.find_secrets(make(SCHEMA, []), ["doc_id"]).collect() == []


def test_only_rules_without_trigrams(make):
    rules = (secretscan.Rule("digits", "[0-9]{4,}"), secretscan.Rule("bad for the parser", r"\p{Lu}{6,}"))
    got = secretscan.find_secrets(make("text string", [("ab 12345 ABCDEFG 99999",)]), ["text"], rules=rules).collect()
    assert [tuple(s) for s in got[0].secrets] == [("digits", 3, 8), ("bad for the parser", 9, 16), ("digits", 17, 22)]


@pytest.mark.parametrize("pattern, alphabet", [
    ("abc[de]f+", "abcdef"), ("(abc|bcd)x?abc", "abcdx"), ("a.*bca", "abc"), ("(?i)ABca{2}", "aBc"), ("(ab|abca)(ca)?b", "abc"),
    ("(abc.|.bca)a", "abc"), ("abca(?=b)", "abc"), ("[abc]{3}abc", "abc"), ("(abc)*", "abc"), ("[^a]bca", "abc"), (r"\babc\b", "abc "),
    ("(abca)+b", "abc"), ("(a(b(c))){1,2}a", "abc"), ("abc|", "abc")])
def test_trigram_queries_are_necessary(pattern, alphabet):
    clauses = secretscan.trigram_query(pattern)
    for size in range(1, 8 if len(alphabet) < 4 else 7):
        for letters in itertools.product(alphabet, repeat=size):
            text = "".join(letters)
            if re.search(pattern, text):
                low = text.lower()
                assert all(any(all(g in low for g in term) for term in clause) for clause in clauses), (text, clauses)


def test_queries_of_the_rules():
    by_kind = {r.kind: secretscan.trigram_query(r.pattern) for r in secretscan.RULES}
    assert by_kind["hex"] == [] and by_kind["access"] == [frozenset({frozenset({"aki", "kia"})})]
    assert frozenset({"tok", "oke", "ken"}) in by_kind["assign"][0] and len(by_kind["assign"][0]) == 6
    assert all(by_kind[k] for k in by_kind if k != "hex")


def test_postings_stay_within_blocks(make):
    keyed = make("k long, g array<boolean>", [(i * 1000, [True, i % 2 == 0]) for i in range(50)])
    got = {(r.block, r.gram): r.docs for r in secretscan.postings(keyed, "k", "g").collect()}
    want = {}
    for i in range(50):
        for gram in (0, 1):
            if gram == 0 or i % 2 == 0:
                want.setdefault((i * 1000 >> 12, gram), []).append(i * 1000 & 4095)
    assert got == want
