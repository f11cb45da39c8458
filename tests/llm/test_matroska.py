import hashlib
import random
import struct
import zlib

import pytest

from tapewright.llm import matroska as mk
from tapewright.llm import queries


def test_numbers_of_every_width():
    for n in (0, 1, 126, 127, 16382, 1 << 20, 1 << 34, (1 << 55) - 1):
        assert mk.read_size(mk._size(n), 0) == (n, len(mk._size(n)))
    assert mk.read_size(b"\xff", 0) == (None, 1)
    assert mk.read_id(bytes.fromhex("1A45DFA3"), 0) == (mk.EBML, 4)
    for bad in (b"", b"\x00", b"\x40"):
        with pytest.raises(mk.Damaged):
            mk.read_size(bad, 0)


@pytest.mark.parametrize("lacing", [mk.XIPH, mk.EBML_LACING, mk.FIXED])
def test_lacing_round_trip(lacing):
    rng = random.Random(lacing)
    for _ in range(50):
        count = rng.randrange(1, 20)
        sizes = [rng.choice([0, 1, 254, 255, 256, 600, 20000]) for _ in range(count)] if lacing != mk.FIXED else [rng.randrange(1, 900)] * count
        frames = [rng.randbytes(s) for s in sizes]
        body = mk.lace(frames, lacing)
        got, at = mk.laced_sizes(body, 0, len(body), lacing)
        assert got == sizes
        for f in frames:
            assert body[at : at + len(f)] == f
            at += len(f)


@pytest.mark.parametrize("frames", [1, 2, 7, 8, 9, 255, 256, 257, 2000])
def test_write_and_read_again(frames):
    payload = random.Random(frames).randbytes(frames * mk.FRAME)
    media = mk.write(payload)
    file = mk.read(media)
    assert file.damage is None and file.tracks[1]["codec"] == "A_PCM/INT/LIT"
    assert b"".join(media[p[2] : p[2] + p[3]] for p in file.packets) == payload
    assert [p[1] for p in file.packets] == [k * 24_000_000 for k in range(frames)]
    assert len(file.cues) == len(file.clusters) == -(-frames // 256)
    for (time, track, place), (body, stamp) in zip(file.cues, file.clusters):
        assert mk.read_id(media, place)[0] == mk.CLUSTER and time == stamp and track == 1


def test_block_groups_unknown_sizes_and_damage():
    block = mk.element(mk.BLOCK_GROUP, mk.element(mk.BLOCK, b"\x81" + struct.pack(">hB", -3, 0) + b"abc"), mk.uint(mk.REFERENCE, 1))
    cluster = mk.CLUSTER.to_bytes(4, "big") + b"\xff" + mk.uint(mk.TIMESTAMP, 10) + block + mk.element(mk.VOID, b"xx")
    segment = mk.SEGMENT.to_bytes(4, "big") + b"\x01" + b"\xff" * 7 + cluster + cluster
    media = mk._EBML_HEADER + segment
    file = mk.read(media)
    assert file.damage is None and len(file.clusters) == 2
    assert [(p[1], media[p[2] : p[2] + p[3]], p[5]) for p in file.packets] == [(7_000_000, b"abc", False)] * 2
    whole = mk.write(bytes(192 * 20))
    cut = mk.read(whole[: len(whole) // 2])
    assert cut.damage and 0 < len(cut.packets) < 20
    assert mk.read(b"not a file").damage and mk.read(b"").damage


def test_query_against_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in queries.documents(spark, sf).collect()}
    rows = queries.op10_matroska_media(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        raw = docs[r.doc_id].encode()
        payload = raw + b" " * ((-len(raw)) % 192 if raw else 192)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert r.media_bytes > r.payload_bytes and r.media_sha256 == hashlib.sha256(mk.write(payload)).hexdigest()


def test_tables_and_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 0), (2, "", 1), (2, "", 2), (None, "é" * 20000, 3)], "doc_id long, text string, media int")
    media = mk.store_texts(docs)
    assert {r["n_packets"] for r in mk.probe(media).collect()} == {1, -(-40000 // 192)}
    table = mk.packets(media)
    assert table.count() == 3 + -(-40000 // 192) and set(r["lacing"] for r in table.collect()) == {"none", "xiph", "fixed", "ebml"}
    odd = spark.createDataFrame([(1, None), (2, b"junk")], "doc_id long, media binary")
    assert mk.packets(odd).collect() == []
    assert all(r["damage"] for r in mk.probe(odd).collect())
    assert mk.round_trip(docs.limit(0)).collect() == []
    trip = {(r.payload_bytes, r.feature) for r in mk.round_trip(docs).collect()}
    assert len(trip) == 2


def test_features_come_from_the_stored_column_and_damage_is_an_error(spark):
    docs = spark.createDataFrame([(1, "abc"), (2, "x" * 500)], "doc_id long, text string")
    media = mk.store_texts(docs)
    assert [(r.doc_id, r.n_bytes) for r in media.orderBy("doc_id").collect()] == [(1, 3), (2, 500)]
    assert {tuple(r) for r in mk.features(media).collect()} == {tuple(r) for r in mk.round_trip(docs).collect()}
    broken = media.selectExpr("doc_id", "n_bytes", "substring(media, 1, 300) as media")
    with pytest.raises(Exception, match="cut short|element"):
        mk.features(broken).collect()
