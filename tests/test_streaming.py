"""Incremental page ingest: pulls land one after the other; the paging rule
holds over all of a key's pages, and a replayed batch adds nothing."""

import json
import os
import tempfile

from tenderscope.plans.medallion import HEADER_RECORD
from tenderscope.streaming import assembled, start_page_ingest


def _land(folder, name, org, month, pages):
    with open(os.path.join(folder, name), "w") as fh:
        for no, status, recs in pages:
            fh.write(json.dumps({"org": org, "mes/ano": month, "page_no": no, "status": status,
                                 "body": json.dumps(recs)}) + "\n")


def _rec(i):
    return {"id": i, "valor": float(i), "modalidade": "m"}


def test_incremental_ingest(spark):
    root = tempfile.mkdtemp(prefix="ts-stream-")
    landing, bronze, ckpt = (os.path.join(root, x) for x in ("landing", "bronze", "ckpt"))
    os.makedirs(landing)
    _land(landing, "a.json", "o", "01/2020", [(1, 200, [_rec(1), _rec(2)]), (2, 200, [_rec(3)]), (3, 200, [])])
    _land(landing, "b.json", "o", "02/2020", [(1, 200, [_rec(4)]), (2, 500, [_rec(5)]), (3, 200, [_rec(6)])])
    def run():
        start_page_ingest(spark, landing, bronze, ckpt, max_files_per_trigger=1).awaitTermination(120)
        return sorted(r.id for r in assembled(spark, bronze, HEADER_RECORD).collect())

    assert run() == [1, 2, 3, 4]
    # a later file of a known key: its pages lie beyond that key's stop page
    _land(landing, "c.json", "p", "01/2020", [(1, 200, [_rec(7)]), (2, 200, [])])
    _land(landing, "d.json", "o", "02/2020", [(4, 200, [_rec(8)])])
    assert run() == [1, 2, 3, 4, 7]


def test_replayed_batch_is_not_ingested_twice(spark):
    root = tempfile.mkdtemp(prefix="ts-stream-")
    landing, bronze = (os.path.join(root, x) for x in ("landing", "bronze"))
    os.makedirs(landing)
    _land(landing, "a.json", "o", "01/2020", [(1, 200, [_rec(1), _rec(2)]), (2, 200, [])])
    for ckpt in ("first", "lost"):  # a lost checkpoint runs batch 0 again
        start_page_ingest(spark, landing, bronze, os.path.join(root, ckpt)).awaitTermination(120)
    assert sorted(r.id for r in assembled(spark, bronze, HEADER_RECORD).collect()) == [1, 2]
