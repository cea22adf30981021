import re

from seatracks.llm import secret_scan as S

from .corpus import SCHEMA, rows


def base(t):
    a = [("assign", m.start(), m.end()) for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.ASCII) if len(m[2]) >= 8]
    b = [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    c = [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    order = ["assign", "access", "hex"]
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(a + b + c, key=lambda x: (x[1], order.index(x[0]))))


def test_base_equals_brute_force_and_stays(spark):
    data = rows()
    got = S.scan_secrets(spark.createDataFrame(data, SCHEMA)).collect()
    assert sorted((r.doc_id, r.base_spans) for r in got) == sorted((d, base(t or "")) for d, t, *_ in data)
    assert all(set(filter(None, r.base_spans.split(","))) <= set(r.spans.split(",")) for r in got)
    assert S.scan_secrets(spark.createDataFrame([], SCHEMA)).count() == 0


def literals(t):
    return [t[a:b] for a, b in S.lex(t)]


def test_lexing():
    assert literals('KEY = "q8Zr5Tn1Lw0Xc7Vb"\nconn.password = KEY\n') == ["q8Zr5Tn1Lw0Xc7Vb"]
    assert literals("dbPassword := 'q8Zr5Tn1' + 'Lw0Xc7Vb'") == ["q8Zr5Tn1", "Lw0Xc7Vb"]
    assert literals("<client_secret>q8Zr5Tn1Lw0Xc7Vb</client_secret>") == ["q8Zr5Tn1Lw0Xc7Vb"]
    assert literals("run --auth-token q8Zr5Tn1Lw0Xc7Vb now") == ["q8Zr5Tn1Lw0Xc7Vb"]
    assert literals('{"privateKey": "q8Zr5Tn1Lw0Xc7Vb"}') == ["q8Zr5Tn1Lw0Xc7Vb"]
    assert literals('password = "changeme"\nsecret = "${ENV}"\ntoken_count = "q8Zr5Tn1Lw0Xc7Vb"\ncolor = "q8Zr5Tn1Lw0Xc7Vb"') == []
    assert literals("password == 'q8Zr5Tn1Lw0Xc7Vb'") == []


def test_redaction(spark):
    assert S.redacted('x password="q8Zr5Tn1Lw0Xc7Vb" y ' + "0af3" * 9) == 'x password="[SECRET]" y [SECRET]'
    docs = spark.createDataFrame(rows(), SCHEMA)
    out = S.redact_secrets(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    for r in out.collect():
        assert r.text is None or (base(r.text) == "" and r.n_chars == len(r.text))


def test_names_of_any_length():
    import time

    long = "k" * 500
    text = f"{long} = 'Zx81-Qm77-Lp20'\npassword = {long}\n"
    assert [text[a:b] for a, b in S.lex(text)] == ["Zx81-Qm77-Lp20"]
    text = f"password_{'x' * 200} = 'Zx81-Qm77-Lp20'; my-api-token: 'Zx81-Qm77-Lp21'"
    assert [text[a:b] for a, b in S.lex(text)] == ["Zx81-Qm77-Lp20", "Zx81-Qm77-Lp21"]
    began = time.process_time()
    for run in ("a" * 300_000, "a-" * 150_000, "a--" * 100_000, "--a" * 100_000, "a." * 150_000, "$a" * 150_000):
        S.lex(run + " password = x")
    assert time.process_time() - began < 20


def test_joined_literals_are_looked_at_whole():
    pad = "a" * 300
    assert literals(f'p = "{pad}"\nauth = p + "Zx81-Qm77"') == [pad, "Zx81-Qm77"]  # all classes, in the last part alone
    mixed = "Zx81-Qm77-Lp20-Rt55-Vw93-Bn46-Cd12-Yh68" * 20
    assert literals(f'p = "{pad}"\npassword = p + "{mixed}"') == [pad, mixed]
    assert literals(f'p = "{mixed}"\npassword = p + "change" + "me"') == []
    assert literals(f'password = "<{mixed}" + "{mixed}" + ">"') == []
    assert literals('p = "' + "x" * 200 + '"\npassword = p + p + p') == []


def test_looks_of_joined_texts():
    import random

    rand = random.Random(5)
    words = ["a", "x" * 90, "X" * 200, "*" * 140, "change", "_me", "exam", "ple", "${", "<", ">", "Zx81-Qm", "é\u0666ß", "A1b2C3d4" * 40, "nil", "placeh", "older", "Q"]
    for _ in range(4000):
        order, texts, looks = {}, [], []
        for _ in range(rand.randint(1, 4)):
            picked = [rand.randrange(len(words) + len(texts)) for _ in range(rand.randint(2, 3))]
            texts.append("".join(([*words, *texts])[i] for i in picked))
            looks.append(S._Looks([([*words, *looks])[i] for i in picked], order))
        assert abs(looks[-1].score(order) - S.literal_score(texts[-1])) < 1e-9, texts[-1][:300]


def test_doubling_a_thousand_times():
    text = 'p0 = "Zx81-Qm77"\n' + "".join(f"p{i + 1} = p{i} + p{i}\n" for i in range(3000)) + "password = p3000 + p1"
    assert literals(text) == ["Zx81-Qm77"]
