import hashlib
import random
import re

from edges import edge_docs, empty_docs, rows_by_key
from ledgerlight.llm import pii

SF = "/root/testdata/sf0.001"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m[0])) <= 15]


def test_anchored_spans_equal_the_patterns():
    rng = random.Random(6)
    alphabets = ["a@b.c ", "a1.@-%", "0123456789. -", "+1 ()-.23", "a@.b@-c.d é\U0001f600"]
    for _ in range(6000):
        text = "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randrange(60)))
        assert [s for s in pii.find(text) if s[0] in pii.BASE_KINDS] == base(text), text


def test_cards_and_added_kinds():
    text = ("Card 4111 1111 1111 1111, not 4111 1111 1111 1112. See https://a.example.org/x?y=1). Account no: DE44 5001 0517 5407 3249 31. "
            "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" accountant 1234567 myhttp://x IBAN 12")
    found = [(k, text[a:b]) for k, a, b in pii.find(text)]
    assert found == [("card", "4111 1111 1111 1111"), ("url", "https://a.example.org/x?y=1"), ("account", "DE44 5001 0517 5407 3249 31"),
                     ("secret", "24be64439e3e49cf46b2d7c90f3602a3d0b907ff")]
    assert not pii.luhn("4111111111111112") and pii.luhn("79927398713")


def test_query_against_brute_force(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in pii.op6_personal_data(spark, SF).collect():
        spans = base(docs[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == x for k, *_ in spans) for x in pii.BASE_KINDS]
        assert r["spans"] == ",".join(f"{k}:{a}:{b}" for k, a, b in pii.find(docs[r["doc_id"]]))


def test_redact(spark):
    df = spark.createDataFrame([(1, "é mail a.b@c.org or +1 (555) 555-0100!"), (2, "none"), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.redact(df, pii.personal_data(df)).collect()}
    assert got == {1: "é mail <EMAIL> or <PHONE>!", 2: "none", 3: None}


def test_edge_rows(spark):
    got = rows_by_key(pii.personal_data(edge_docs(spark)))
    assert len(got[7]) == 2 and all(r["spans"] == [] for rows in got.values() for r in rows)
    assert pii.personal_data(empty_docs(spark)).count() == 0
    assert pii.find("9" * 200000) == [] and pii.find("a@" * 50000) == []


def test_long_numbers_cost_their_length():
    import time
    start = time.perf_counter()
    assert pii.find("1" * 1_000_000) == [] and pii.find("1." * 3) == []
    assert time.perf_counter() - start < 1
    assert [s[0] for s in pii.find("1" * 500_000 + " 10.0.0.1")] == ["ip"]


def test_cues_in_any_spelling_and_check_digits():
    found = lambda t: [(k, t[a:b]) for k, a, b in pii.find(t)]
    assert found("iBaN: DE44500105175407324931 x") == [("account", "DE44500105175407324931")]
    assert found("IBAN: DE45500105175407324931 x") == [] and found("aCCount 12345678") == [("account", "12345678")]
    assert found("Passport: AB1234567") == [("account", "AB1234567")] and found("\u0130 IBAN GB82 WEST 1234 5698 7654 32") == [("account", "GB82 WEST 1234 5698 7654 32")]
    assert pii.iban("GB82 WEST 1234 5698 7654 32") and not pii.iban("GB83WEST12345698765432") and not pii.iban("1234567890123456")


def spelled_out(text):
    """The added kinds without an automaton: every place of the text is tried for every cue."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    out = []
    for kind, cues in (("url", pii.SCHEMES), ("account", pii.ACCOUNT_CUES), ("secret", pii.SECRET_CUES)):
        found, over = [], 0
        places = sorted((i + len(c) - 1, -len(c), i) for c in cues for i in range(len(text)) if lower.startswith(c, i))
        for last, _, at in places:
            end = last + 1
            if at < over or (at and re.match("[A-Za-z0-9]", text[at - 1])) or (kind != "url" and re.match("[A-Za-z0-9]", text[end:end + 1])):
                continue
            if kind == "url":
                m = re.match(r"[A-Za-z0-9\[][^\x00-\x20\"'<>`{}|\\^\x7f]*", text[end:])
                value = m[0].rstrip(".,;:!?)]*") if m else ""
                span = (at, end + len(value)) if value else None
            else:
                skip = re.match(r"(?:[\x20\t]*(?:no\.?|nr\.?|number|num|id|n\u00b0|#))?[\x20\t]*[:=#]?[\x20\t]*[\"']?", text[end:], re.I)
                begin = end + len(skip[0])
                m = re.match(r"[A-Z]{0,3}[0-9](?:[\x20-]?[A-Z0-9]){5,33}" if kind == "account" else r"[A-Za-z0-9_\-/+=.]{16,}", text[begin:])
                span = None
                if m:
                    plain, digits = re.sub("[ -]", "", m[0]), len(re.findall("[0-9]", m[0]))
                    written = kind == "account" and re.match("[A-Z][A-Z][0-9][0-9]", m[0]) and len(plain) >= 15
                    moved = "".join(str("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ".index(c)) for c in plain[4:] + plain[:4]) if written else "1"
                    if kind == "account" and digits >= 6 and (int(moved) % 97 == 1 and len(plain) <= 34 if written else True) or \
                            kind == "secret" and digits >= 4 and re.search("[A-Za-z]", m[0]):
                        span = (begin, begin + len(m[0]))
            if span:
                found.append(span)
                over = span[1]
        out += [(kind, a, b) for a, b in found]
    return out


def test_added_kinds_against_brute_force(spark):
    docs = [r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rng = random.Random(16)
    parts = ["http://", "HTTPS://a.b", "iban", "Account", "ssn:", "token=", "Api Key", "DE44500105175407324931", "12345678", "a1b2c3d4e5f6a7b8c9", " no. ", "x.y/z?", ". ", "\"", ":", "#", " "]
    docs += ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(3000)]
    for text in docs:
        assert [s for s in pii.find(text) if s[0] not in pii.BASE_KINDS] == spelled_out(text), text
