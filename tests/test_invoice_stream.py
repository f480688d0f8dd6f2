"""J8 as a stream: the same invoices and lines as one batch load, in any order of the files."""

import json
import os
import random

import fixtures
import pytest

from ledgerspark.sources import api_json as J
from ledgerspark.streaming import invoices as S

NOW = "2024-06-01T00:00:00Z"


def doc(i, date, lines, total=1, status="SENT"):
    return {"id": i, "number": f"n{i}", "customerId": "c", "status": status, "total": total,
            "invoiceDate": date, "dueDate": date, "lines": [
                {"description": t, "quantity": 1, "unitPrice": 2, "total": 3} for t in lines]}


def write(root, name, docs):
    path = os.path.join(root, name)
    fixtures.write(path, json.dumps({"data": docs}))
    return path


def batch(spark, root):
    headers, lines = J.load_invoices(J.invoices_source(spark, root), NOW)
    return J.upsert_invoices(None, headers), J.upsert_invoice_lines(None, lines, headers)


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def same_as_batch(spark, root, target):
    headers, lines = batch(spark, root)
    assert rows(S.read_invoices(spark, target)) == rows(headers)
    assert rows(S.read_invoice_lines(spark, target)) == rows(lines)


def drop(scratch, path):
    """The file again under the same path, seen as a new one by the stream's order of times."""
    stamp = 1.7e9 + drop.n
    drop.n += 60
    os.utime(path, (stamp, stamp))


drop.n = 0


@pytest.mark.parametrize("seed", range(2))
def test_stream_equals_batch_in_any_order(spark, scratch, seed):
    r = random.Random(seed)
    root, files = os.path.join(scratch, "in"), []
    for f in range(6):
        docs = [doc(f"i{r.randrange(8)}", f"2024-0{r.randrange(1, 5)}-03",
                    [f"f{f}", "same"][:r.randrange(3)], total=f) for _ in range(r.randrange(1, 5))]
        files.append(write(root, f"f{f}.json", docs))
    r.shuffle(files)
    for path in files:
        drop(scratch, path)
    S.stream_invoices(spark, root, scratch + "/t", scratch + "/ck", NOW, buckets=4,
                      max_files_per_trigger=1 + seed).awaitTermination()
    same_as_batch(spark, root, scratch + "/t")


def test_moved_replaced_and_replayed(spark, scratch):
    root, target = os.path.join(scratch, "in"), scratch + "/t"

    def load(path):
        S.merge_invoices(spark, J.invoices_source(spark, path), target, NOW, buckets=4)

    a = write(root, "a.json", [doc("1", "2024-01-05", ["x", "y"]), doc("2", "2024-02-05", ["z"])])
    b = write(root, "b.json", [doc("1", "2024-03-05", []), doc("3", "", ["no date"])])
    load(a)
    load(b)
    same_as_batch(spark, root, target)
    # the only invoice of January has moved to March, its lines are gone
    assert not os.path.exists(os.path.join(target, "headers", "month=2024-01"))
    assert rows(S.read_invoice_lines(spark, target).where("invoice_id = '1'")) == []
    for path in (b, a, a, b):                    # replays and late older files change nothing
        load(path)
        same_as_batch(spark, root, target)


def test_failure_before_the_index_is_repaired_by_the_replay(spark, scratch, monkeypatch):
    root, target = os.path.join(scratch, "in"), scratch + "/t"
    a = write(root, "a.json", [doc("1", "2024-01-05", ["x"]), doc("2", "2024-01-06", ["z"])])
    b = write(root, "b.json", [doc("1", "2024-02-05", ["x", "new"])])
    S.merge_invoices(spark, J.invoices_source(spark, a), target, NOW, buckets=4)
    real = S.overwrite_partitions

    def failing(spark, state, path, column, values):
        if path.endswith("index"):
            raise RuntimeError("lost")
        real(spark, state, path, column, values)

    monkeypatch.setattr(S, "overwrite_partitions", failing)
    with pytest.raises(RuntimeError):
        S.merge_invoices(spark, J.invoices_source(spark, b), target, NOW, buckets=4)
    monkeypatch.setattr(S, "overwrite_partitions", real)
    S.merge_invoices(spark, J.invoices_source(spark, b), target, NOW, buckets=4)
    same_as_batch(spark, root, target)


def test_empty_batch(spark, scratch):
    path = write(os.path.join(scratch, "in"), "a.json", [])
    S.merge_invoices(spark, J.invoices_source(spark, path), scratch + "/t", NOW)
    assert not os.path.exists(scratch + "/t")
