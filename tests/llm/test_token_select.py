"""Operator 9: offsets come through select, and a second attempt at a shard changes nothing."""

import zlib

import numpy as np
import pytest

from pkgsift.llm import token_files as tf


@pytest.mark.parametrize("n,top", [(1, 0), (3, 5), (700, 40), (5000, 1 << 40), (2000, 0)])
def test_select_many(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top + 1, n)).astype(np.uint64)
    ef = tf.EliasFano.build(values)
    for k in (np.arange(n), np.arange(n)[::7], np.array([n - 1]), np.zeros(0, int)):
        assert ef.select_many(k).tolist() == values[k].tolist() == [ef.select(int(i)) for i in k]


def test_shard_is_read_through_select(tmp_path, monkeypatch):
    """No table of all boundaries is made, and a bounded number is selected at a time."""
    (tmp_path / "_temporary").mkdir()
    rng = np.random.default_rng(1)
    ids = [rng.integers(0, 60_000, n).astype("<u2").tobytes() for n in (3, 0, 700, 1, 5, 0, 900)]
    docs = [None, None, 4, 4, 9, 1 << 40, (1 << 40) + 1]
    tf.write_shard(str(tmp_path), 0, ids, docs, "<u2", 2)
    before = (tmp_path / "ids-000000.eftk").read_bytes()
    tf.write_shard(str(tmp_path), 0, ids, docs, "<u2", 2)  # a repeated task
    assert (tmp_path / "ids-000000.eftk").read_bytes() == before
    monkeypatch.setattr(tf.EliasFano, "all", lambda self: (_ for _ in ()).throw(AssertionError("all boundaries at once")))
    monkeypatch.setattr(tf, "SELECTED", 2)
    rows = [r for b in tf.shard_rows(str(tmp_path), 0, 100) for r in b.to_pylist()]
    at = 100
    assert [r["doc_id"] for r in rows] == docs
    for r, own in zip(rows, ids):
        assert (r["start"], r["n_tokens"]) == (at, len(own) // 2)
        assert r["ids_crc32"] == zlib.crc32(np.frombuffer(own, "<u2").astype("<u4").tobytes())
        at += len(own) // 2


def test_rename_that_refuses_an_existing_target(tmp_path, monkeypatch):
    """On a store whose rename refuses an existing file, the second attempt leaves the first one's bytes."""
    from pkgsift.llm import common

    class Strict:
        def __init__(self, fs):
            self.fs = fs

        def move(self, a, b):
            if self.fs.get_file_info(b).type.name == "File":
                raise OSError("exists")
            self.fs.move(a, b)

        def __getattr__(self, name):
            return getattr(self.fs, name)

    real = common.filesystem
    monkeypatch.setattr(tf, "filesystem", lambda uri: (Strict(real(uri)[0]), real(uri)[1]))
    (tmp_path / "_temporary").mkdir()
    for _ in range(2):
        tf.write_shard(str(tmp_path), 3, [b"\x01\x00"], [7], "<u2", 2)
    assert [p.name for p in (tmp_path / "_temporary").iterdir()] == []
