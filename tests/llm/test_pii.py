import hashlib
import random
import re

from fieldloom.llm.pii import digest, redact

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    worth = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in worth) % 10 == 0


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in match.split(".")), "card": lambda: 14 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 10 <= len(digits) <= 15}[kind]()


def brute(text):
    spans = [(m.start(), rank, m.end(), kind) for rank, kind in enumerate(PLAIN) for m in re.finditer(PLAIN[kind], text) if holds(kind, m[0])]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(spans)]


PIECES = ["1", "23", "4111 1111 1111 1111", ".", "..", "@", "a", "b-c", "+", "%_", "+1 (017) 555-7713", "-", " ", "é😀", "x.y@z.com", "255", "256", "0000255", "\n", "GB82 WEST 1234 5698 7654 32"]


def check(df):
    texts = {(r.doc_id, r.text) for r in df.collect()}
    by_id = {}
    for r in digest(df).collect():
        by_id.setdefault(r.doc_id, []).append(r)
    for doc_id, text in texts:
        wanted = brute(text or "")
        sha = hashlib.sha256(",".join(wanted).encode()).hexdigest()
        r = next(r for r in by_id[doc_id] if r.base_sha256 == sha)
        assert [s for s in r.spans.split(",") if s and not s.startswith("iban")] == wanted
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in wanted) for k in PLAIN]


def test_spans(spark, docs, odd, none):
    random.seed(3)
    made = [(i, "".join(random.choice(PIECES) for _ in range(random.randint(0, 40)))) for i in range(2000)]
    check(spark.createDataFrame(made, "doc_id long, text string"))
    check(docs)
    check(odd)
    assert digest(none).count() == 0


def test_checks_and_context(odd, spark):
    r = digest(odd.filter("doc_id = 14")).first()
    kinds = [s.split(":")[0] for s in r.spans.split(",")]
    assert kinds == ["email", "phone", "card", "ip", "iban"]
    assert r.scores.split(",")[0] == "0.90"  # 'mail' stands before it
    wrong = spark.createDataFrame([(1, "DE89 3704 0044 0532 0130 01")], "doc_id long, text string")
    assert digest(wrong).first().n_iban == 0


def test_long_runs_take_linear_time(spark):
    rows = [(1, "a" * 300_000), (2, "1" * 300_000), (3, "1." * 100_000), (4, "+1" + " " * 300_000), (5, "a@" * 50_000), (6, "A1" * 100_000)]
    assert digest(spark.createDataFrame(rows, "doc_id long, text string")).count() == 6


def test_redact(odd, none):
    out = redact(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    text = out.filter("doc_id = 14").first().text
    assert "@" not in text and "<email>" in text and "<iban>" in text and "555" not in text
    assert out.filter("doc_id = 5").first().text is None
    assert redact(none).count() == 0


def test_secrets_of_any_length_and_case(spark, none):
    values = ["a1" * n for n in (4, 64, 65, 100, 5000)] + ["Zz9-/+_x"]
    named = [f"{name}{sign}{v}" for v in values for name in ("token", "TOKEN", "Password", "api_key", "ApiKey", "SECRET", "passwd") for sign in ("=", ": ", ' = "')]
    rows = [(i, f"see {t} there") for i, t in enumerate(named)]
    for r in digest(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert r.spans == f"secret:4:{4 + len(named[r.doc_id])}", named[r.doc_id][:40]
    for text in ("token=abc1234", "TOKEN=abcdefghij", "xtoken=a1a1a1a1", "AKIA" + "0" * 15, "AKIA" + "0" * 17):
        assert digest(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().n_secret == 0
    assert digest(spark.createDataFrame([(1, "AKIA" + "Z" * 15 + "7")], "doc_id long, text string")).first().spans == "secret:0:20"
