import hashlib
import re
import time

from helpers import documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, text):
    digits = re.sub(r"[^0-9]", "", text)
    if kind == "ip":
        return all(int(p.lstrip("0")[:4] or 0) <= 255 for p in text.split("."))
    if kind == "card":
        total = sum(int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    out = [(m.start(), m.end(), k) for k, p in BASE.items() for m in re.finditer(p, text or "") if holds(k, m[0])]
    return sorted(out, key=lambda s: (s[0], list(BASE).index(s[2])))


@settings(max_examples=600, deadline=None)
@given(st.text("0123456789.@+-() aB%\n", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert [s for s in pii.spans(text) if s[2] in BASE] == brute(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "4111111111111112", "a.b@c.de", "@", "x@y", "+1 (212) 555-0199", "1.2.3.4", "256.1.1.1", "9.9.9.9.9.9.9.9", "00000000000000", "é", " ", "\n", "+", "0" * 5000 + ".1.1.1"]), max_size=8).map("".join))
def test_base_spans_of_joined_pieces(text):
    assert [s for s in pii.spans(text) if s[2] in BASE] == brute(text)


def test_method_adds_spans_and_leaves_plain_text_alone():
    kinds = lambda t: [(t[s:e], k) for s, e, k in pii.spans(t)]
    assert kinds("call ftp://joe:pw@host/x") == [("joe:pw", "account")] or ("joe:pw", "account") in kinds("call ftp://joe:pw@host/x")
    assert ("DE89 3704 0044 0532 0130 00", "account") in kinds("IBAN DE89 3704 0044 0532 0130 00.")
    assert not [k for k in kinds("IBAN DE89 3704 0044 0532 0130 01.") if k[1] == "account"]
    assert kinds("Account no. : 12345678 please") == [("12345678", "account")]
    assert kinds("lives at 12 Old Mill Road, Springfield") == [("12 Old Mill Road, Springfield", "address")]
    assert kinds("joe (at) mail (dot) org") == [("joe (at) mail (dot) org", "address")]
    assert kinds("A token of love, the road ahead and 12 account holders at street level; streets: 5") == []


def test_table(spark):
    df = documents(spark)
    got = {r["doc_id"]: r for r in pii.find(df).collect()}
    assert pii.find(df).count() == df.count()
    assert got[0]["base_sha256"] == hashlib.sha256(b"").hexdigest() and got[0]["spans"] == "" and got[0]["redacted"] is None
    one = pii.find(documents(spark, [(1, "mail a@b.co now"), (None, None)])).orderBy("doc_id").collect()
    assert (one[1]["n_email"], one[1]["spans"], one[1]["redacted"]) == (1, "email:5:11", "mail [EMAIL] now")
    assert one[1]["base_sha256"] == hashlib.sha256(b"email:5:11").hexdigest()
    assert pii.find(empty(spark)).count() == 0


def test_credentials_with_known_prefixes():
    for secret in ("AKIA" + "A1B2" * 4, "ghp_" + "a1B2" * 9, "github_pat_" + "a_1" * 10, "sk_live_" + "4eC39HqLyjWD", "xoxb-123456789012-abcDEF"):
        text = f"see {secret}, please"
        assert (4, 4 + len(secret), "account") in pii.spans(text)
        assert pii.spans("x" + secret.rstrip("-")) == [] or all(k != "account" for _, _, k in pii.spans("x" + secret))
    key = "-----BEGIN RSA PRIVATE KEY-----\nMIIEow\nIBAA==\n-----END RSA PRIVATE KEY-----"
    assert (2, 2 + len(key), "account") in pii.spans(f"a {key} b")
    assert [k for _, _, k in pii.spans("-----BEGIN PRIVATE KEY----- and no end")] == ["account"]
    assert pii.spans("-----BEGIN CERTIFICATE----- AKIA ghp_ sk_live_") == []


def test_very_long_texts_are_read_in_linear_time():
    for part in ("1", "1.", "+1", "a@a", "://", "-----BEGIN PRIVATE KEY-----", "AKIA", "token = "):
        began = time.process_time()
        pii.spans(part * (1_000_000 // len(part)))
        assert time.process_time() - began < 30, part
