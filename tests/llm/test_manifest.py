import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tapewright.llm import manifest, queries
from tapewright.llm.shared import Work

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*(field(row[c]) for c in manifest.FIELDS))


def up(nodes):
    """The root of a list, and the siblings of each of its members with their sides."""
    proofs = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            beside = place ^ 1
            proofs[k].append((nodes[beside] if beside < len(nodes) else None, place % 2))
        at = [x // 2 for x in at]
        nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], proofs


def brute(rows, tampered=lambda r: r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0):
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, subroots = {}, []
    for lang in langs:
        own = sorted((r for r in rows if r["lang"] == lang), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        top, proofs = up([leaf_of(r) for r in own])
        trees[lang] = (own, top, proofs)
        subroots.append(top)
    root, above = up(subroots) if subroots else (None, [])
    out = []
    for k, lang in enumerate(langs):
        own, top, proofs = trees[lang]
        for r, proof in zip(own, proofs):
            proof = proof + above[k]
            shown = dict(r)
            if tampered(r) and r["n_chars"] is not None:
                shown["n_chars"] += 1
            got = leaf_of(shown)
            for sibling, side in proof:
                got = h(got) if sibling is None else h(sibling, got) if side else h(got, sibling)
            out.append((r["doc_id"], leaf_of(r), top, root, h(*(s for s, _ in proof if s)), got, got == root))
    return sorted(out, key=repr)


def as_query(docs, step=manifest.STEP):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found = manifest.manifest(docs, {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}, step=step)
    rows = found.select("doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("path")), "folded_root", "verified").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def made(n, seed, langs=("en", "de", None, "é")):
    rng = random.Random(seed)
    return [{"doc_id": i, "text": rng.choice(["", "é" * rng.randrange(9), "word " * rng.randrange(30), None]), "lang": rng.choices(langs, [9, 4, 2, 1][: len(langs)])[0], "source": rng.choice(["web", None]), "n_chars": rng.choice([None, i])} for i in rng.sample(range(10 * n + 1), n)]


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], SCHEMA)


@pytest.mark.parametrize("n", [1, 2, 3, 40])
def test_small_tables_against_brute_force(spark, n):
    rows = made(n, n)
    assert as_query(frame(spark, rows)) == brute(rows)


@pytest.mark.parametrize("step", [1, 2, 3])
def test_several_tiers(spark, step):
    """Blocks of 2, 4 and 8 nodes: proofs go over up to six tiers, of documents and of groups."""
    rows = made(50, 7, tuple(f"l{k}" for k in range(4))) + [r | {"doc_id": 1000 + k, "lang": f"x{k}"} for k, r in enumerate(made(9, 8))]
    assert as_query(frame(spark, rows).repartition(5), step) == brute(rows)


def test_nulls_repeats_and_clashing_columns(spark):
    rows = made(20, 3)
    rows += [rows[0], rows[0], rows[1] | {"doc_id": None}, rows[2] | {"doc_id": None}, rows[3] | {"doc_id": rows[4]["doc_id"]}]
    docs = frame(spark, rows)
    for name in ("pos", "at", "node", "grp", "g", "id", "path", "_tie", "root"):
        docs = docs.withColumn(name, F.lit("x"))
    assert as_query(docs) == brute(rows)
    assert any(r[0] is None for r in as_query(docs))


def test_empty_table_and_long_text(spark):
    assert as_query(frame(spark, [])) == []
    rows = [{"doc_id": 1, "text": "längér " * 300_000, "lang": "en", "source": "s", "n_chars": 1}]
    assert as_query(frame(spark, rows)) == brute(rows)


def test_every_tampered_row_is_found_and_no_other(spark, sf):
    rows = [r.asDict() for r in queries.documents(spark, sf).collect()]
    got = queries.op13_merkle_manifest(spark, sf).collect()
    bad = {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None}
    assert {r.doc_id for r in got if not r.verified} == bad and bad
    assert sorted((tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in got), key=repr) == brute(rows)


def test_other_fields_and_groups(spark):
    rows = made(12, 5)
    found = manifest.manifest(frame(spark, rows), fields=("doc_id", "text"), group="source").collect()
    assert len(found) == 12 and all(r.verified for r in found) and len({r.subroot for r in found}) == len({r["source"] for r in rows})


def test_windows_hold_a_block_at_most(spark):
    """One group of 5,000 rows is dealt to many blocks: no window is partitioned by the group alone."""
    rows = [{"doc_id": i, "text": "t", "lang": "en", "source": "s", "n_chars": 1} for i in range(5000)]
    work = Work(spark)
    placed = manifest.placed(manifest.numbered(frame(spark, rows).select(F.col("doc_id").alias("id"), F.col("lang").alias("grp"), F.col("source").alias("node")), ["grp", "id"], work, "rows"), work, "rows")
    assert sorted(r.pos for r in placed.collect()) == list(range(5000))
    plan = manifest.tier(placed)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(g" in plan and "_block" in plan.split("hashpartitioning(g")[1].split(")")[0] and plan.count("Exchange hashpartitioning(g") == 1
