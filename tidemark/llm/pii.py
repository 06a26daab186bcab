"""Personal data: Aho-Corasick finds cues, and local parsers expand and validate what stands around them."""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in the order of ties. The first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "address", "account")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
DIGITS = re.compile(r"[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")

#: Words that announce an account, a credential or an official number, and what may stand between them and it.
ACCOUNT_CUES = ("account", "acct", "iban", "ssn", "passport", "token", "password", "passwd", "api_key", "apikey", "secret_key", "customer id")
AFTER_CUE = re.compile(r"(?: ?(?:no|nr|number|num|id)\b\.?)?[ \t]*(?:[:=#]|is\b)[ \t]*[\"']?", re.IGNORECASE)
ACCOUNT = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9_/+-]|[ ](?=[0-9]{2,4}\b)){4,79}")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
#: Prefixes by which issued credentials are known, with what follows them (fixed values).
SECRETS = {
    "AKIA": r"[A-Z0-9]{16}", "ASIA": r"[A-Z0-9]{16}", "ghp_": r"[A-Za-z0-9]{20,255}", "gho_": r"[A-Za-z0-9]{20,255}", "ghs_": r"[A-Za-z0-9]{20,255}",
    "github_pat_": r"[A-Za-z0-9_]{20,255}", "sk_live_": r"[A-Za-z0-9]{10,255}", "sk_test_": r"[A-Za-z0-9]{10,255}", "rk_live_": r"[A-Za-z0-9]{10,255}",
    "xoxb-": r"[A-Za-z0-9-]{10,255}", "xoxp-": r"[A-Za-z0-9-]{10,255}", "-----BEGIN ": r"(?:[A-Z0-9]+ ){0,4}PRIVATE KEY-----(?:[A-Za-z0-9+/=\s]{0,20000}-----END [A-Z0-9 ]{0,40}-----)?",
}
AFTER_PREFIX = {p: re.compile(x) for p, x in SECRETS.items()}
USERINFO = re.compile(r"[^\s/@:]{1,64}(?::[^\s/@]{1,128})?(?=@[A-Za-z0-9.-])")
#: Words that end the name of a street.
STREETS = ("Street", "Avenue", "Road", "Boulevard", "Lane", "Drive", "Straße", "Strasse")
BEFORE_STREET = re.compile(r"\b[0-9]{1,5}[A-Za-z]?(?: [A-Z][\w'.-]{0,30}){1,4} \Z")
AFTER_STREET = re.compile(r"(?:, [A-Z][\w' .-]{1,40})?(?:,? [A-Z]{2})?(?:,? [0-9]{5}(?:-[0-9]{4})?\b)?")
OBFUSCATED_DOMAIN = re.compile(r" ?[A-Za-z0-9-]+(?: ?[(\[]dot[)\]] ?[A-Za-z0-9-]+)+", re.IGNORECASE)


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    cues = {d: "digit" for d in "0123456789"} | {"@": "at", "+": "plus", "://": "scheme"} | dict.fromkeys(("(at)", "[at]", "(AT)", "[AT]"), "hidden at")
    cues |= {w: "identifier" for cue in ACCOUNT_CUES for w in (cue, cue.capitalize(), cue.upper())} | {" " + w: "street" for w in STREETS}
    cues |= dict.fromkeys(SECRETS, "secret")
    for w, kind in cues.items():
        a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def iban_holds(text: str) -> bool:
    s = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def account_after(text: str, end: int, cue_start: int) -> tuple[int, int] | None:
    """The identifier that a cue ending at `end` announces."""
    if cue_start and text[cue_start - 1].isalnum():
        return None
    m = AFTER_CUE.match(text, end)
    if m and (found := ACCOUNT.match(text, m.end())) and sum(c.isdigit() for c in found[0]) >= 4:
        return found.span()
    return None


def spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) in order of start, then kind. Base spans are leftmost and don't overlap within their kind."""
    if not text:
        return []
    out: list[tuple[int, int, str]] = []
    mail = ip = card = account = 0  # where the last match or attempt of each kind ended
    for last, (cue, size) in automaton().iter(text):
        if cue == "digit":
            if last >= card:
                if m := CARD.match(text, last):
                    card, digits = m.end(), NOT_DIGIT.sub("", m[0])
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        out.append((*m.span(), "card"))
                else:
                    card = last + 1
            if last >= ip:
                if m := IP.match(text, last):
                    ip = m.end()
                    if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m.groups()):
                        out.append((*m.span(), "ip"))
                else:
                    ip = DIGITS.match(text, last).end()
        elif cue == "at":
            start = last
            while start > mail and text[start - 1] in LOCAL:
                start -= 1
            if start < last and (m := DOMAIN.match(text, last + 1)):
                mail = m.end()
                out.append((start, mail, "email"))
        elif cue == "plus":
            if (m := PHONE.match(text, last)) and 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((*m.span(), "phone"))
        elif cue == "secret":
            start = last + 1 - size
            if start >= account and not (start and text[start - 1].isalnum()) and (m := AFTER_PREFIX[text[start : last + 1]].match(text, last + 1)):
                account = m.end()
                out.append((start, account, "account"))
        elif cue == "scheme":
            if (m := USERINFO.match(text, last + 1)) and m.start() >= account:
                account = m.end()
                out.append((*m.span(), "account"))
        elif cue == "street":
            begin = max(0, last - 160)
            street = last + 1
            word = last + 2 - size
            if (street == len(text) or not text[street].isalnum()) and (m := BEFORE_STREET.search(text[begin:word])):
                end = AFTER_STREET.match(text, street).end()
                out.append((begin + m.start(), end, "address"))
        elif cue == "hidden at":
            start = last - 3
            if start and text[start - 1] == " ":
                start -= 1
            end, begin = start, start
            while begin and end - begin < 64 and text[begin - 1] in LOCAL:
                begin -= 1
            if begin < end and (m := OBFUSCATED_DOMAIN.match(text, last + 1)):
                out.append((begin, m.end(), "address"))
        else:
            if (at := account_after(text, last + 1, last + 1 - size)) and at[0] >= account:
                account = at[1]
                out.append((*at, "account"))
            elif text[last + 1 - size : last + 1].lower() == "iban":
                m = IBAN.search(text, last + 1, last + 50)
                if m and m.start() - last < 8 and m.start() >= account and iban_holds(m[0]):
                    account = m.end()
                    out.append((*m.span(), "account"))
    rank = {k: i for i, k in enumerate(KINDS)}
    return sorted(set(out), key=lambda s: (s[0], rank[s[2]], s[1]))


def listed(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in found)


def redact(text: str | None, found: list[tuple[int, int, str]]) -> str | None:
    """The text with its spans replaced by their kinds in brackets; of overlapping spans the first is replaced."""
    if not found:
        return text
    out, at = [], 0
    for s, e, k in found:
        if s >= at:
            out += [text[at:s], f"[{k.upper()}]"]
            at = e
    return "".join(out) + text[at:]


def find(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_address, n_account, redacted.

    Positions are code points, ends exclusive. `spans` also holds the kinds that the cues add: addresses (streets and
    written-out mail addresses) and accounts (numbers and credentials after an identifier cue, credentials with a known
    prefix, private keys, checked account numbers, user information before the host of a URL). One pass without a shuffle; memory is that of a batch.

    Nulls: a null text is empty: no spans, the hash of an empty list, and a null `redacted`; a null doc_id is kept.
    Repeated rows each yield a row. An empty table yields no rows. Texts of any length are read whole."""

    def work(batches):
        for b in batches:
            cols: list[list] = [[] for _ in range(9)]
            for t in b.column(1):
                text = t.as_py()
                found = spans(text)
                kinds = [k for _, _, k in found]
                base = [s for s in found if s[2] in KINDS[:4]]
                for c, v in zip(cols, (*(kinds.count(k) for k in KINDS[:4]), hashlib.sha256(listed(base).encode()).hexdigest(), listed(found), kinds.count("address"), kinds.count("account"), redact(text, found)), strict=True):
                    c.append(v)
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()] * 2 + [pa.string()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_address", "n_account", "redacted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_address long, n_account long, redacted string")
