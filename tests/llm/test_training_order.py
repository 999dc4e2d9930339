import zlib

import numpy as np
import pytest

from platewise.llm import training_order as M
from platewise.llm.common import run_dir
from platewise.llm.tokens import FastTokenizer


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 17, 64, 65, 1000, 4097])
def test_permutation_is_a_bijection_with_inverse(n):
    slot = M.permute(np.arange(n), n)
    assert sorted(slot.tolist()) == list(range(n))
    assert (M.permute(slot, n, inverse=True) == np.arange(n)).all()


def test_keys_give_other_orders():
    a, b = (M.permute(np.arange(1000), 1000, key=k) for k in (1, 2))
    assert (a != b).mean() > 0.9 and (a != np.arange(1000)).mean() > 0.9


def expected(rows, sequence):
    out = []
    for (i, _), ids in zip(rows, FastTokenizer().ids([t or "" for _, t in rows])):
        ids = np.append(ids, 1).astype("<u4")
        out += [(i, k, ids[s:s + sequence].tobytes()) for k, s in enumerate(range(0, len(ids), sequence))]
    return sorted(out, key=str)


def test_shards_hold_every_sequence_once(spark, odd, odd_rows):
    path = run_dir(spark, "t") + "/s"
    layout = M.write_shards(odd, path, sequence=64, shard_bytes=3000)
    got = M.read_slots(spark, path, layout).collect()
    assert sorted(r.slot for r in got) == list(range(layout["sequences"]))
    assert sorted([(r.doc_id, r.piece, bytes(r.ids)) for r in got], key=str) == expected(odd_rows, 64)
    for r in got:
        assert r.shard == r.slot // layout["per_shard"] and r.ids_crc32 == zlib.crc32(bytes(r.ids))
        assert r.byte_offset == r.slot % layout["per_shard"] * layout["stride"] and r.n_tokens == len(r.ids) // 4
    files = {r.shard: bytes(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()}
    for r in got:  # the record is where arithmetic says
        at = files[r.shard][r.byte_offset:r.byte_offset + layout["stride"]]
        assert int.from_bytes(at[:8], "little", signed=True) == (r.doc_id or 0)
        assert int.from_bytes(at[12:16], "little") == r.n_tokens
    resumed = M.read_slots(spark, path, layout, 10, 25, with_ids=False).collect()
    assert sorted(r.slot for r in resumed) == list(range(10, 25))


def test_same_key_same_files(spark, odd):
    a, b = (run_dir(spark, "t") + "/s" for _ in range(2))
    la, lb = M.write_shards(odd, a, sequence=64), M.write_shards(odd, b, sequence=64)
    assert la == lb
    rows = [sorted(map(tuple, M.read_slots(spark, p, la).select("slot", "ids_crc32").collect())) for p in (a, b)]
    assert rows[0] == rows[1]


def test_groups_of_any_size_share_one_buffer(spark, odd, odd_rows, monkeypatch):
    for size in (64, 4096):
        monkeypatch.setattr(M, "GROUPED_BYTES", size)
        path = run_dir(spark, "t") + "/s"
        layout = M.write_shards(odd, path, sequence=64, shard_bytes=3000)
        got = M.read_slots(spark, path, layout).collect()
        assert sorted([(r.doc_id, r.piece, bytes(r.ids)) for r in got], key=str) == expected(odd_rows, 64)


def test_shards_are_not_copied_between_scan_and_reader(spark, odd):
    path = run_dir(spark, "t") + "/s"
    layout = M.write_shards(odd, path, sequence=64)
    assert "Project" not in M.read_slots(spark, path, layout)._jdf.queryExecution().executedPlan().toString()


def test_empty_table(spark, none):
    assert M.materialised(none).count() == 0
