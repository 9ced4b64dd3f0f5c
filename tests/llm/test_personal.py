import hashlib
import random
import re

from firnline.llm import personal

RULES = list(personal.PLAIN.items())


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    out = []
    for kind, rule in RULES:
        for m in re.finditer(rule, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0, "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def texts():
    rng = random.Random(5)
    parts = ["a@b.c", "x.y@mail5.example.com", "@", ".", "..", "-", " ", "  ", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (523) 555-1055", "+49 30 1234567",
             "foo", "é", "🇩🇪", "7", "00", "\n", "+", "(", "_", "%", "a-b@c-d.e-f", "1.2.3.4.5", "Dr. Anna Smith", "\u0001", "123-45-6789", "b@c"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 30))) for _ in range(400)]
    return [*made, "", None, "a" * 60_000, "1" * 60_000, "1 " * 30_000, "a.a." * 20_000 + "@" + "b." * 20_000 + "c", "mail@host.example " * 3_000, "+1" + "(" * 50_000, "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "token = \"%s\"" % ("1eb9c654" * 5)]


def test_base_spans_against_the_plain_patterns(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "a@b.c"), (3, "a@b.c"), (3, "a@b.c")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, spans string, _kind int").repartition(8)
    got = [(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in personal.find(docs).collect()]
    want = []
    for i, t in rows:
        spans = base(t)
        n = [sum(k == s[0] for s in spans) for k, _ in RULES]
        want.append((i, *n, hashlib.sha256(",".join("%s:%d:%d" % s for s in spans).encode()).hexdigest()))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_added_spans_and_mask(spark):
    rows = [(i, f"filler text {i}. token = \"{hashlib.sha1(str(i).encode()).hexdigest()}\" end. Contact Dr. Anna Smith at é a{i}@mail.example.com") for i in range(40)] + [(99, None), (98, "plain")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, n_chars long")
    got = {r.doc_id: r.spans for r in personal.find(docs).collect()}
    for i, t in rows[:40]:
        spans = [s.split(":") for s in got[i].split(",")]
        assert {(k, t[int(a) : int(b)]) for k, a, b in spans} >= {("email", f"a{i}@mail.example.com"), ("secret", hashlib.sha1(str(i).encode()).hexdigest()), ("name", "Dr. Anna Smith")}
    assert got[99] == "" and got[98] == ""
    masked = personal.mask(docs)
    assert masked.columns == docs.columns
    out = {r.doc_id: (r.text, r.n_chars) for r in masked.collect()}
    assert out[0] == ('filler text 0. token = "[SECRET]" end. Contact [NAME] at é [EMAIL]',) + (len(out[0][0]),)
    assert out[99] == (None, 5) and out[98] == ("plain", 5)


def test_em_finds_the_reliable_labeler():
    rng = random.Random(1)
    counts = {}
    for _ in range(4000):
        y = rng.random() < 0.5
        say = lambda right: (1 if y else -1) if rng.random() < right else (-1 if y else 1)  # noqa: E731, B023
        p = ("secret", (say(0.95), say(0.9), say(0.6), 0))
        counts[p] = counts.get(p, 0) + 1
    _, like = personal.reliabilities(counts)
    right = [(like["secret", i, 1, 1] + like["secret", i, -1, 0]) / 2 for i in range(3)]
    assert right[0] > 0.9 and right[1] > 0.85 and right[2] < 0.7


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert personal.find(docs).count() == 0 and personal.mask(docs).count() == 0
