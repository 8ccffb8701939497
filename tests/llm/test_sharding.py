import zlib
from collections import Counter, defaultdict

from rushcart.llm.sharding import shard, write_shards
from .conftest import ODD, prose


def test_shards_are_near_equal_and_groups_stay_together(docs):
    rows = [(i, prose(20 + i % 150, i // 2 if i % 5 else 0)) for i in range(2000)]
    result = shard(docs(rows)).collect()
    assert len(result) == len(rows)
    size, slots, of_text = Counter(), defaultdict(list), defaultdict(set)
    text = dict(rows)
    for r in result:
        assert r["size"] == len(text[r.doc_id].encode()) + 1
        assert r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r.law == "bytes" and r.grown_shard is None
        size[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        of_text[text[r.doc_id]].add(r.shard)
    assert set(size) == set(range(8))
    assert max(size.values()) / min(size.values()) < 1.1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert all(len(x) == 1 for x in of_text.values())


def test_one_text_outweighs_a_shard(docs):
    rows = [(i, "the same long text " * 20 if i % 3 == 0 else prose(40, i)) for i in range(900)]
    size = Counter()
    for r in shard(docs(rows)).collect():
        size[r.shard] += r["size"]
    hot = max(size, key=size.get)
    rest = [n for s, n in size.items() if s != hot]
    assert size[hot] == 300 * (19 * 20 + 1) and max(rest) / min(rest) < 1.15


def test_slots_of_ranges_dealt_over_tasks(docs, monkeypatch):
    monkeypatch.setattr("rushcart.llm.sharding.TOGETHER", 20)
    slots = defaultdict(list)
    for r in shard(docs([(i, "same" if i % 2 else f"t {i}") for i in range(600)])).collect():
        slots[r.shard].append(r.slot)
    assert sum(map(len, slots.values())) == 600
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_odd_rows(docs):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(1, ""), (1, ""), (None, "a")]
    result = shard(docs(rows)).collect()
    assert len(result) == len(rows)
    assert {(r["size"], r.text_crc32) for r in result if r.doc_id in (0, 1)} == {(1, 0)}
    assert shard(docs([])).count() == 0


def test_reruns_agree(docs):
    rows = [(i, prose(30, i)) for i in range(300)]
    place = lambda df: sorted((r.doc_id, r.shard, r.slot) for r in shard(df).collect())
    assert place(docs(rows)) == place(docs(rows[::-1]).repartition(7))


def test_written_shards_hold_all_rows(spark, docs, tmp_path):
    df = docs([(i, prose(10, i % 40)) for i in range(100)] + [(200, None)])
    write_shards(df, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 101 and {"key", "size", "shard"} <= set(back.columns)
    where = {r.doc_id: r.shard for r in shard(df).collect()}
    assert {r.doc_id: r.shard for r in back.collect()} == where
