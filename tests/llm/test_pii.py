import hashlib
import random
import re

from touchline.llm.pii import BASE, find, redact


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    text, out = text or "", []
    patterns = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    for k, (kind, pattern) in enumerate(zip(BASE, patterns, strict=True)):
        for m in re.finditer(pattern, text, re.ASCII):
            d = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if good:
                out.append((m.start(), k, kind, m.end()))
    return [(kind, b, e) for b, _, kind, e in sorted(out)]


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(11)
    parts = ["a@b.c", "x.y@m-1.example.com", "@", "a@b", ".", "1.2.3.4", "256.1.1.1", "000000000000001.2.3.4", "1.2.3.4.5.6.7.8", "4111 1111-1111 1111", "5500005555555559", "12", " - ", "+1 (017) 555-7713", "+49-30.123456", "+", " ", "é", "\U0001f600", "%d@e.f", "0", "--", "7 7", "()", "\n"]
    texts = [None, "", "1 " * 9_000, "7" * 30_000, "a" * 30_000, "+" + "1(" * 9_000, "1." * 3_000, "a@b.c%d@e.f", "9 4111111111111111"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(1500)]
    rows = find(spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, kind string").repartition(4)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert [(s.kind, s.begin, s.end) for s in r.spans if s.base] == brute(texts[r.doc_id]), texts[r.doc_id]


def test_classifier_adds_secrets_and_people_and_redacts(spark):
    texts = [f'plain words here {i} token = "{hashlib.sha1(str(i).encode()).hexdigest()}" and so on' for i in range(30)]
    texts += ["dear Mr. John Smith we wrote", "justalongwordofmanylettersanditgoesonandon here", None, "4111 1111 1111 1112 fails"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: [(s.kind, s.begin, s.end) for s in r.spans] for r in find(frame).collect()}
    assert all([k for k, *_ in got[i]] == ["secret"] for i in range(30))
    assert [k for k, *_ in got[30]] == ["person"] and got[31] == [] and got[32] == [] and got[33] == []
    out = {r.doc_id: r.text for r in redact(frame).collect()}
    assert out[3] == 'plain words here 3 token = "<SECRET>" and so on' and out[30] == "dear <PERSON> we wrote" and out[32] is None and out[33] == texts[33]
    assert redact(frame.limit(0)).count() == 0 and redact(frame).columns == frame.columns


def test_query_counts_and_digest(spark, tmp_path):
    from touchline.llm.queries import op10_pii

    texts = [None, "", "mail a.b@c.de or 10.0.0.1 now", "call +49 30 1234567 and card 4111 1111 1111 1111", "a@b.c a@b.c 1.2.3.4"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in op10_pii(spark, str(tmp_path)).collect():
        base = brute(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, *_ in base) for kind in BASE)
        written = ",".join(f"{k}:{b}:{e}" for k, b, e in base)
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()


def test_many_spans_in_one_text_and_long_secrets(spark):
    import time

    n = 100_000
    mails = " ".join(f"u{i}@ex.org" for i in range(n))
    secret = "Ab3" * 100
    texts = [(1, mails, 7), (2, f"token = \"{secret}\" é " * 3 + f"{secret[:199]} {secret[:201]}", 8), (3, "é a@b.cd, é" * 2000 + "end", 9)]
    texts += [(10 + i, f'my token = "{hashlib.sha1(str(i).encode()).hexdigest()}" is set', 1) for i in range(40)]
    frame = spark.createDataFrame(texts, "doc_id long, text string, __spans long")
    start = time.perf_counter()
    got = {r.doc_id: (len(r.spans), r.spans[-1].begin if r.spans else None) for r in find(frame).collect()}
    assert got[1] == (n, mails.rindex("u")) and got[3][0] == 2000
    assert got[2][0] == 5  # a secret of any length is one
    out = {r.doc_id: r for r in redact(frame).collect()}
    assert out[1].text == " ".join(["<EMAIL>"] * n) and out[1]["__spans"] == 7
    assert out[3].text == "é <EMAIL>, é" * 2000 + "end"
    assert time.perf_counter() - start < 120
