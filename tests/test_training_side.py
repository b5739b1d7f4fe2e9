"""Token batches, leakage-free split, record-aligned CSV, salvage of archives, running totals."""

import csv
import gzip
import io
import random
import tarfile
import time
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pkgsift.functions import prompts as PR
from pkgsift.operators import batches as BA
from pkgsift.operators import split as SP
from pkgsift.operators.group_components import linked_groups
from pkgsift.operators.prefix_sums import md5_order, running_total
from pkgsift.sources import archives as AR
from pkgsift.sources import csv_records as CR
from pkgsift.sources import review_csv as RC


# running totals ------------------------------------------------------------

@pytest.mark.parametrize("cell_rows", [1, 50, 20_000])
def test_running_total(spark, cell_rows):
    rng = random.Random(1)
    rows = [(k, rng.choice("abc") if k % 3 else "a", rng.randrange(5)) for k in range(600)] + [(None, None, 2), (900, None, 1)]
    df = spark.createDataFrame(rows, "id long, g string, w long").withColumn("o", md5_order(7, F.coalesce(F.col("id").cast("string"), F.lit(""))))
    got = running_total(df, ["g"], "o", F.col("w"), "before", ["id"], cell_rows=cell_rows).collect()
    for g in ("a", "b", "c", None):
        own = sorted((r for r in got if r["g"] == g), key=lambda r: r["o"])
        total = 0
        for r in own:
            assert r["before"] == total
            total += r["w"]
    assert len(got) == len(rows)


# token batches -------------------------------------------------------------

def last_start(ids, templ):
    return max((k + 1 for k in range(len(ids) - len(templ) + 1) if templ and ids[k:k + len(templ)] == templ), default=None)


@settings(max_examples=40, deadline=None)
@given(data=st.data())
def test_template_start(spark, data):
    templ = data.draw(st.lists(st.integers(0, 2), max_size=3))
    rows = data.draw(st.lists(st.lists(st.integers(0, 12), max_size=12), min_size=1, max_size=6))
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, ids array<int>")
    t = F.array(*map(F.lit, templ)).cast("array<int>")
    got = dict(df.select("k", PR.template_start(F.col("ids"), t)).collect())
    assert got == {k: last_start(r, templ) for k, r in enumerate(rows)}


def test_template_start_is_linear(spark):
    """A row of a million tokens, full of near occurrences."""
    df = spark.range(1).select(F.concat(F.array_repeat(F.lit(7), 1_000_000), F.array(*map(F.lit, (7, 7, 8, 1)))).alias("ids"))
    start = time.time()
    assert df.select(PR.template_start(F.col("ids"), F.array(*map(F.lit, (7, 7, 8))))).first()[0] == 1_000_001
    assert time.time() - start < 30


@pytest.mark.parametrize("size,longest,width", [(4, 20, 5), (3, 7, 100), (1, 50, 8)])
def test_token_batches(spark, size, longest, width):
    rng = random.Random(size)
    templ = [1, 2]
    rows = [(k, [rng.randrange(4) for _ in range(rng.randrange(30) if k % 2 else 9)]) for k in range(120)] + [(500, None), (501, [])]
    df = spark.createDataFrame(rows, "key long, ids array<int>").repartition(5)
    got = [r.asDict() for r in BA.token_batches(df, "key", "ids", F.array(*map(F.lit, templ)), size, longest, -9, width).collect()]
    of = dict(rows)
    assert sorted(r["key"] for r in got) == sorted(of)
    batches = {}
    for r in got:
        batches.setdefault(r["batch"], []).append(r)
        ids = (of[r["key"]] or [])[:longest]
        pad = len(r["input_ids"]) - len(ids)
        start = last_start(ids, templ)
        assert r["input_ids"] == ids + [-9] * pad
        assert r["attention_mask"] == [1] * len(ids) + [0] * pad
        assert r["labels"] == [x if start and k >= start - 1 else -100 for k, x in enumerate(ids)] + [-100] * pad
    assert sorted(batches) == list(range(len(batches)))
    lengths = {b: {len((of[r["key"]] or [])[:longest]) // width for r in own} for b, own in batches.items()}
    assert all(len(x) == 1 for x in lengths.values())  # one length bucket each, shortest first
    order = [min(lengths[b]) for b in sorted(lengths)]
    assert order == sorted(order)
    for b, own in batches.items():
        assert {len(r["input_ids"]) for r in own} == {max(len((of[r["key"]] or [])[:longest]) for r in own)}
        last = b + 1 not in lengths or lengths[b + 1] != lengths[b]
        assert len(own) == size or (last and len(own) < size)


# leakage-free split --------------------------------------------------------

def brute_groups(rows):
    label = {r[0]: r[0] for r in rows}
    changed = True
    while changed:
        changed = False
        for col in range(1, len(rows[0])):
            by = {}
            for r in rows:
                if r[col] is not None:
                    by[r[col]] = min(by.get(r[col], label[r[0]]), label[r[0]])
            for r in rows:
                if r[col] is not None and by[r[col]] < label[r[0]]:
                    label[r[0]], changed = by[r[col]], True
    return label


@pytest.mark.parametrize("seed", range(3))
def test_linked_groups(spark, seed):
    rng = random.Random(seed)
    rows = [(f"n{rng.randrange(60):02d}", rng.choice([None, f"s{rng.randrange(50)}"]), f"t{rng.randrange(400)}") for _ in range(120)]
    rows += [(f"n{k}", f"c{k}", f"c{k + 1}") for k in range(100, 160)]  # a chain over two columns needs both
    rows = [(a, b, c) for a, b, c in rows] + [(f"n{k}", f"d{k // 2}", f"e{(k + 1) // 2}") for k in range(200, 260)]
    df = spark.createDataFrame(rows, "node string, a string, b string")
    got = {r["node"]: r["group"] for r in linked_groups(df, "node", ["a", "b"]).collect()}
    assert got == brute_groups(rows)


def test_leakage_free_split(spark):
    rng = random.Random(4)
    rows = []
    for p in range(700):
        for _ in range(1 if p % 3 else rng.randrange(1, 6)):
            rows.append((f"p{p}", f"s{rng.randrange(2500)}", int(p % 4 == 0)))
    rows += [("hot", f"h{k}", 0) for k in range(300)] + [(None, "alone", 1), (None, "h3", 0)]
    df = spark.createDataFrame(rows, "package string, textual_description string, label int").repartition(6)
    got = SP.leakage_free_split(df).collect()
    assert sorted((r[0] or "", r[1], r[2]) for r in got) == sorted((p or "", s, y) for p, s, y in rows)
    for col in ("package", "textual_description"):
        sides = {}
        for r in got:
            if r[col] is not None:
                sides.setdefault(r[col], set()).add(r["split"])
        assert all(len(x) == 1 for x in sides.values())
    sizes = {s: sum(r["split"] == s for r in got) for s in SP.SPLITS}
    n = len(rows)
    n_test = -(-n // 10)
    assert sizes["test"] == n_test  # rows alone in their unit fill the quota exactly
    assert sizes["validation"] == -(-(n - n_test) // 9)
    again = SP.leakage_free_split(df.repartition(2)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))  # partitions don't matter


# record-aligned CSV --------------------------------------------------------

FIELDS = st.text(alphabet='ab", \n\r\'é', max_size=8)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(FIELDS, min_size=1, max_size=4), min_size=1, max_size=6))
def test_line_states(rows):
    """The state after each line of a file is that of a reader going over every character."""
    out = io.StringIO()
    csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_MINIMAL).writerows(rows)
    state, inside = False, False
    for line in out.getvalue().split("\n"):
        inside = CR.ends_inside(line, inside)
        k = 0
        fresh = not state
        while k < len(line):
            c = line[k]
            if state:
                if c == '"':
                    if line[k + 1:k + 2] == '"':
                        k += 1
                    else:
                        state = False
                fresh = False
            elif c == '"' and fresh:
                state, fresh = True, False
            else:
                fresh = c == ","
            k += 1
        assert inside == state


@pytest.fixture
def small_ranges(spark):
    key = "spark.sql.files.maxPartitionBytes"
    was = spark.conf.get(key)
    spark.conf.set(key, "1024")
    yield
    spark.conf.set(key, was)


def test_parallel_read_equals_the_single_task_read(spark, tmp_path, small_ranges):
    rng = random.Random(2)
    pieces = ['"', ",", "\n", "a", "é", " ", "\r\n", "x,y", '""', "NA"]
    for name in ("one.csv", "two.csv"):
        with open(tmp_path / name, "w", newline="") as f:
            w = csv.writer(f, lineterminator="\n")
            w.writerow(["id", "te xt", "c"])
            for k in range(700):
                text = "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))
                w.writerow([f"{name}{k}", "\n" * 3000 if k == 333 else text, rng.choice(["", "z", "q\nr"])])
    one = RC.read_csv_strings(spark, str(tmp_path))
    many = CR.read_csv_parallel(spark, str(tmp_path))
    assert many.columns == one.columns
    assert sorted(map(str, many.collect())) == sorted(map(str, one.collect())) and one.count() == 1400
    assert CR._lines(spark, str(tmp_path / "one.csv")).rdd.getNumPartitions() > 4  # one file, many tasks
    assert RC.read_csv_strings(spark, str(tmp_path), parallel=True).count() == 1400


def test_parallel_read_of_odd_files(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_bytes(b"x,y\r\n1,\"a\r\nb\"\r\n\r\n2,\"\"\r\n3\r\n4,c\"d\"e,6\r\n5,\"open " + b"z\n" * 900)
    got = sorted(tuple(r) for r in CR.read_csv_parallel(spark, str(tmp_path)).collect())
    assert [g[0] for g in got] == ["1", "2", "3", "4", "5"]
    assert got[0][1].replace("\r\n", "\n") == "a\nb" and got[2][1] is None and got[3][1] == 'c"d"e'
    (tmp_path / "same").mkdir()
    (tmp_path / "same/a.csv").write_bytes(b"x,y\n1,\"\"\n2,\n3, \n4\n")
    one, many = (sorted(map(str, read(spark, str(tmp_path / "same")).collect())) for read in (RC.read_csv_strings, CR.read_csv_parallel))
    assert one == many and len(one) == 4
    assert got[4][1].startswith("open z\nz") and got[4][1].count("z") == 900
    (tmp_path / "b").mkdir()
    (tmp_path / "b/only.csv").write_text("x,y\n")
    assert CR.read_csv_parallel(spark, str(tmp_path / "b")).collect() == []


# damaged archives ----------------------------------------------------------

def tar_of(files, mode="w"):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as t:
        for name, body in files:
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    return out.getvalue()


FILES = [(f"d/f{k}.py", bytes([65 + k]) * (700 * k + 3)) for k in range(5)]


def read(name, data):
    return list(AR.archive_members(name, io.BytesIO(data)))


def test_tar_goes_on_behind_a_damaged_header():
    raw = bytearray(tar_of(FILES))
    at = tarfile.open(fileobj=io.BytesIO(bytes(raw))).getmembers()[2].offset
    raw[at + 148] = 0x78
    got = read("a.tar.gz", gzip.compress(bytes(raw)))
    assert [(m[0], m[2]) for m in got if m[0]] == [f for k, f in enumerate(FILES) if k != 2]
    lost = [m for m in got if m[0] is None]
    assert len(lost) == 1 and "f3.py" in lost[0][3] and lost[0][1] == 512 + 1536  # the header and its body


def test_tar_of_garbage_and_cut_tar():
    got = read("a.tar", b"garbage " * 300)
    assert len(got) == 1 and got[0][0] is None and got[0][3]
    raw = tar_of(FILES)
    at = tarfile.open(fileobj=io.BytesIO(raw)).getmembers()[4].offset_data
    found = []
    with pytest.raises(tarfile.ReadError):
        found += [m for m in AR.archive_members("a.tar", io.BytesIO(raw[:at + 10])) if found.append(m) or False]
    assert [m[0] for m in found] == [n for n, _ in FILES] and found[4][2] is None and found[4][3]
    assert [m[2] for m in found[:4]] == [b for _, b in FILES[:4]]


def test_two_tars_in_one_file():
    got = read("a.tar", tar_of(FILES[:2]) + tar_of(FILES[2:]))
    assert [m[0] for m in got] == [n for n, _ in FILES]


@pytest.mark.parametrize("method", [zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED])
@pytest.mark.parametrize("streamed", [False, True])
def test_zip_without_directory(method, streamed):
    class Pipe(io.RawIOBase):  # a sink that cannot seek makes headers without sizes
        def __init__(self):
            self.data = bytearray()

        def writable(self):
            return True

        def write(self, b):
            self.data += b
            return len(b)

    out = Pipe() if streamed else io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, body in FILES:
            z.writestr(name, body)
    data = bytes(out.data) if streamed else out.getvalue()
    got = read("a.zip", data[:data.index(b"PK\x01\x02")])
    assert got[0][0] is None and got[0][3]
    if streamed and method == zipfile.ZIP_STORED:
        assert [m[0] for m in got[1:]] == [n for n, _ in FILES]
    else:
        assert [(m[0], m[2]) for m in got[1:]] == FILES


def test_zip_with_one_damaged_body():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in FILES:
            z.writestr(name, body)
        at = z.infolist()[1].header_offset + 30 + len(FILES[1][0])
    data = bytearray(out.getvalue())
    data[at] ^= 0xFF
    got = read("a.zip", bytes(data))
    assert [m[0] for m in got] == [n for n, _ in FILES] and got[1][2] is None and got[1][3]
    assert [m[2] for m in got if m[3] is None] == [b for k, (_, b) in enumerate(FILES) if k != 1]
    cut = bytes(data[:data.index(b"PK\x01\x02")])
    assert [m[0] for m in read("a.zip", cut) if m[2] is not None] == [n for k, (n, _) in enumerate(FILES) if k != 1]
