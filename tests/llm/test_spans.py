"""PII and secret spans against plain regular expressions run over whole texts."""

import hashlib
import random
import re

import public_tokenizers
import pytest

from gradmesh.llm import anchors, token_secrets

VOCAB = public_tokenizers.path("byte_bpe_50k.tiktoken")


def spans_of(pattern, text, ok=lambda m: True, flags=re.ASCII):
    return [m.span() for m in re.finditer(pattern, text, flags) if ok(m)]


def digits(m):
    return re.sub("[^0-9]", "", m[0])


def brute_pii(t):
    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0

    return {
        "email": spans_of(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t),
        "ip": spans_of(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t, lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        "card": spans_of(r"[0-9]([\x20-]?[0-9])+", t, lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": spans_of(r"\+[0-9][\x20().0-9-]+[0-9]", t, lambda m: 9 <= len(digits(m)) <= 15),
    }


def brute_secrets(t):
    return {
        "assign": spans_of(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, lambda m: len(m[2]) >= 6, re.I | re.ASCII),
        "access": spans_of(r"AKIA[A-Z0-9]+", t, lambda m: len(m[0]) >= 20),
        "hex": spans_of(r"[0-9a-f]+", t, lambda m: len(m[0]) >= 24),
    }


def noise(seed, alphabet, n):
    rng = random.Random(seed)
    return "".join(rng.choice(alphabet) for _ in range(n))


PII_TEXTS = [
    "", None, "é@x a@b.c@d.e a@b@c.d .@-.- x@y.z.", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.4 1.2.3", "4111 1111 1111 1111, 4111-1111-1111-1112 4111--1111",
    "+1 (555) 010-9999 +12 +1.2 ++49 30 1234567-", "٣٤٥ ½ ² ① 1٣", "x" * 50_000 + "@a.b" + "1 " * 20_000,
    *(noise(s, "0123456789.- +@ab()é\n", 3000) for s in range(20)),
]
SECRET_TEXTS = [
    "", None, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "API_KEY:abc apikey=abcdef ſecret=abcdefg toKen=abcdefg tokentoken=aaaaaa", "AKIA" + "A" * 15 + " AKIAAKIA" + "B" * 16,
    "password='secret=abcdef'", *(noise(s, "0123456789abcdefAKI=:\"' tokensecretpwd", 3000) for s in range(20)),
]


def test_pii_equals_brute_force(spark):
    rows = [(k, t) for k, t in enumerate(PII_TEXTS)] + [(None, "a@b.c"), (0, "")]
    got = anchors.pii_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    want = {}
    for k, t in rows:
        b = brute_pii(t or "")
        joined = ",".join(f"{kind}:{s}:{e}" for kind in anchors.BASE for s, e in b[kind])
        want[k] = ([len(b[x]) for x in anchors.BASE], hashlib.sha256(joined.encode()).hexdigest(), joined)
    for r in got:
        n, sha, joined = want[r.doc_id]
        assert [r[f"n_{x}"] for x in anchors.BASE] == n, r.doc_id
        assert r.base_sha256 == sha
        assert r.spans.startswith(joined)


def test_pii_method_spans(spark):
    t = "see https://bob:pw1@host/x IBAN: DE89 3704 0044 0532 0130 00 now, iban DE00 3704 0044 0532 0130 00; account no: 12-34567X, maccount no 123456, passport none"
    df = spark.createDataFrame([(1, t, "clash")], "doc_id long, text string, kind string")
    got = {(r.kind, r.value) for r in anchors.pii_spans(df).collect()}
    assert {("login", "bob:pw1"), ("account", "DE89 3704 0044 0532 0130 00"), ("account", "12-34567X")} <= got
    assert not [v for k, v in got if v == "123456" or v.startswith("DE00 ")]


@pytest.mark.parametrize("op", [anchors.pii_digest, lambda d: token_secrets.secret_digest(d, VOCAB)])
def test_empty_table(spark, op):
    assert op(spark.createDataFrame([], "doc_id long, text string, spans int")).count() == 0


def test_secrets_equal_brute_force(spark):
    rows = [(k, t) for k, t in enumerate(SECRET_TEXTS)] + [(None, "token=abcdefgh"), (0, "")]
    order = {k: n for n, k in enumerate(token_secrets.BASE)}
    for r in token_secrets.secret_digest(spark.createDataFrame(rows, "doc_id long, text string"), VOCAB).collect():
        b = brute_secrets(dict(rows)[r.doc_id] or "")
        joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted((s, order[k], k, e) for k in b for s, e in b[k]))
        assert [r[f"n_{k}"] for k in token_secrets.BASE] == [len(b[k]) for k in token_secrets.BASE], r.doc_id
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()


def test_token_efficiency_tells_random_strings(spark):
    known = "d41d8cd98f00b204e9800998ecf8427e 123e4567-e89b-12d3-a456-426614174000 2024-01-02T10-20-30 release_2024_candidate_build internationalization-support-module-2 1234567890123456789"
    rows = [(1, "key xK9vQ2mZp7LrT4wBn8Jc end"), (2, known), (3, "aGVsbG8gd29ybGQhIQ9x7Zk2Qp " * 2), (4, "the " * 5000)]
    got = {r.doc_id: r.n_random for r in token_secrets.secret_digest(spark.createDataFrame(rows, "doc_id long, text string"), VOCAB).collect()}
    assert got == {1: 1, 2: 0, 3: 2, 4: 0}


def test_secrets_behind_names_without_digits_and_behind_dates():
    enc, rng = token_secrets.encoder(VOCAB), random.Random(3)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    for lead in ("downloads/documents/archive/private/", "user_authentication_session_identifier=", "2024-01-02-", "international" * 60 + "/", "downloadsdocumentsarchiveprivate"):
        for alphabet in (letters + "0123456789", letters):
            for _ in range(20):
                key = "".join(rng.choice(alphabet) for _ in range(24))
                spans = token_secrets.find(f"see {lead}{key} end", enc)["random"]
                at = 4 + len(lead)
                covered = {x for a, b in spans for x in range(a, b)}
                assert len(covered & set(range(at, at + 24))) >= 16, (lead, key, spans)
    clean = "releases/2024-01-02T10-20-30/candidate_build docs/123e4567-e89b-12d3-a456-426614174000/internationalization"
    assert token_secrets.find(clean, enc)["random"] == []


def test_cues_in_any_case_and_large_ids():
    find = anchors.Finder()
    for t in ("Tax ID: AB-123456", "TAX id: AB-123456", "Customer ID: AB-123456", "iBan: DE89 3704 0044 0532 0130 00", "cUsToMeR iD AB-123456"):
        assert find(t)["account"], t
    assert find("İİ Tax ID: AB-123456 end")["account"] == [(11, 20)]
    assert anchors.lowered("AİB") == "aİb"


def test_spans_keep_ids_beside_null_ones(spark):
    docs = spark.createDataFrame([(None, "a@b.cd"), (2**60 + 1, "é a@b.cd secret: abcdefgh")], "doc_id long, text string").coalesce(1)
    got = {(r.doc_id, r.kind, r.start, r.value) for r in anchors.pii_spans(docs).collect()}
    assert got == {(None, "email", 0, "a@b.cd"), (2**60 + 1, "email", 2, "a@b.cd")}
    assert [(r.doc_id, r.kind, r.value) for r in token_secrets.secret_spans(docs, VOCAB).collect()] == [(2**60 + 1, "assign", "secret: abcdefgh")]


def test_thresholds_by_class_of_characters():
    """Recall of planted keys by alphabet; made-up words in the case of a word aren't keys."""
    enc, rnd = token_secrets.encoder(VOCAB), random.Random(3)
    low, up, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    for letters, least in ((low + up + digits, 0.99), (low + up, 0.98), (up + "234567", 0.98), (low + digits, 0.98), (low, 0.85)):
        keys = ["".join(rnd.choice(letters) for _ in range(24)) for _ in range(400)]
        found = [any(e - s >= 16 for s, e in token_secrets.find(f"the key {k} here", enc)["random"]) for k in keys]
        assert sum(found) >= least * len(keys), letters
    for word in ("dieeinkeitgekeit", "Enheiteinzuschte", "undeinpfkeitheit", "internationalization", "Donaudampfschiffahrtsgesellschaft"):
        assert token_secrets.find(f"a {word} b", enc)["random"] == [], word
