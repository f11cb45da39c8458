import hashlib
import math
import random
import re

from tapewright.llm import pii, queries

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) for i, c in enumerate(reversed(d))) % 10 == 0


def good(kind, s):
    d = re.sub("[^0-9]", "", s)
    return {"email": True, "ip": all(int(p) <= 255 for p in s.split(".")) if kind == "ip" else True, "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def brute(text):
    return sorted((m.start(), k, m.end()) for k, (kind, p) in enumerate(BASE.items()) for m in re.finditer(p, text or "") if good(kind, m.group()))


def written(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_query_base_spans_against_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in queries.documents(spark, sf).collect()}
    rows = queries.op9_pii_spans(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = brute(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(written(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in want) for j in range(4)]
        assert set(written(want).split(",")) - {""} <= set(r.spans.split(","))


def test_base_spans_on_random_and_extreme_texts(spark):
    rng = random.Random(7)
    parts = ["a", "b.c", "@", ".", "..", "-", "+1", "+", "%y", " ", "  ", "1", "12", "255", "256", "007", "1.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "(555) 010-9999", "x@y.z", "é", "😀", "\n", "5500000000000004", "_", "999999999999"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(600)]
    texts += [None, "", "9" * 60000, "1.2.3.4." * 3000, "a@" + "b." * 20000 + "c", "a" * 50000 + "@", "1 2-3" * 9000, "+1" + " 2" * 9000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in docs.select("doc_id", pii.base_spans("coalesce(text, '')").alias("b")).collect():
        assert [(x.s, x.k, x.e) for x in r.b] == brute(texts[r.doc_id]), texts[r.doc_id][:200]


def test_terms_that_give_an_entity_away(spark):
    rng = random.Random(3)
    filler = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(filler) for _ in range(30)) for _ in range(200)]
    texts += [f"{rng.choice(filler)} Surgeon Quimby{i % 2} wrote to jo@x.org today {rng.choice(filler)} {i}" for i in range(8)]
    texts += ["the surgeon is out"] * 1 + ["surgeon quimby0 again and again"] + [texts[200]] * 50
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, entity string")
    got = {(r.entity, r.term): r for r in pii.disclosing_terms(docs).collect()}
    distinct = list(dict.fromkeys(texts))
    has = lambda t, w: w in re.findall(r"[^\W_]{2,}", t.lower())
    n_entity = sum("jo@x.org" in t for t in distinct)
    for word in ("surgeon", "quimby0", "quimby1", "wrote", "today", "w1"):
        both = sum("jo@x.org" in t and has(t, word) for t in distinct)
        n_term = sum(has(t, word) for t in distinct)
        d = math.log(both * len(distinct) / (n_entity * n_term)) / math.log(len(distinct) / n_entity) if both >= 3 else 0
        assert (("email:jo@x.org", word) in got) == (d >= pii.GENERALISE)
        if d >= pii.GENERALISE:
            assert abs(got["email:jo@x.org", word].disclosure - d) < 1e-9
    out = {r.doc_id: r for r in pii.find(docs).collect()}
    assert out[200].sanitised.startswith(texts[200].split()[0]) and "[EMAIL]" in out[200].sanitised and "wrote" not in out[200].sanitised
    assert out[5].sanitised == texts[5] and out[208].sanitised == "the surgeon is out"


def test_edge_cases(spark):
    docs = spark.createDataFrame([(None, None), (1, ""), (1, "a@b.cd")], "doc_id long, text string")
    assert sorted(r.n_email for r in pii.digest(pii.find(docs)).collect()) == [0, 0, 1]
    assert pii.find(docs.limit(0)).collect() == []


def test_disclosure_over_whole_texts_against_brute_force(spark):
    rng = random.Random(17)
    filler = [f"w{i}" for i in range(40)]
    texts = []
    for k in range(150):
        words = [rng.choice(filler) for _ in range(rng.randrange(5, 400))]
        if k % 3 == 0:
            words[0] = f"Name{k % 5}"  # far from the entity, which ends the text
            words.append(f"mail{k % 5}@host.org")
        if k % 7 == 0:
            words.insert(len(words) // 2, "10.0.0.7")
        texts.append(" ".join(words))
    texts += [texts[0]] * 30 + [texts[3]] * 4 + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    distinct = {t or "" for t in texts}
    terms = {t: set(re.findall(r"[^\W_]{2,}", t.lower())) for t in distinct}
    entities = {t: {f"{pii.KINDS[k]}:{t[a:b].lower()}" for a, k, b in brute(t)} for t in distinct}
    want = {}
    for e in set().union(*entities.values()):
        own = [t for t in distinct if e in entities[t]]
        for w in set().union(*(terms[t] for t in own)):
            both, n_term = sum(w in terms[t] for t in own), sum(w in terms[t] for t in distinct)
            d = math.log(both * len(distinct) / (len(own) * n_term)) / math.log(len(distinct) / len(own))
            if both >= pii.SUPPORT and d >= pii.GENERALISE:
                want[e, w] = (both, len(own), n_term, round(d, 9))
    got = {(r.entity, r.term): (r.n_both, r.n_entity, r.n_term, round(r.disclosure, 9)) for r in pii.disclosing_terms(docs).collect()}
    assert got == want and ("email:mail0@host.org", "name0") in got


def test_secrets_and_sanitised_digest(spark):
    key = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    texts = [f'token = "{key}" and a@b.cd', "3" * 40, "f" * 40, f"x{key}", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.digest(pii.find(docs)).collect()}
    assert [(rows[i].n_secret, rows[i].n_private) for i in range(5)] == [(1, 2), (0, 0), (0, 0), (0, 0), (0, 0)]
    assert rows[0].spans == "secret:9:49,email:55:61"
    assert rows[0].sanitised_sha256 == hashlib.sha256(b'token = "[SECRET]" and [EMAIL]').hexdigest()
    assert rows[4].sanitised_sha256 == hashlib.sha256(b"").hexdigest()
