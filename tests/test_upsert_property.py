"""Upsert against a dictionary model: after any sequence of batches the
table holds, per key, the last row written (later batch, then later row)."""
import datetime as dt

from hypothesis import given, settings, strategies as st

from conftest import RUN_TS
from verdant import contract as K
from verdant.operators import clean as CL
from verdant.operators import upsert as UP
from verdant.session import fresh_dir

STAMPS = [dt.datetime(2025, 4, 15, 2, 28, 40), dt.datetime(2025, 4, 15, 9, 0, 0),
          dt.datetime(2025, 4, 16, 0, 0, 1), dt.datetime(2025, 5, 5, 16, 4, 32)]
PLANTS = ["Plant 1", "Plant 2", "Plant 3"]
row = st.tuples(st.sampled_from(STAMPS), st.sampled_from(PLANTS),
                st.sampled_from(["Healthy", "Wilted", "Dead"]))
batches = st.lists(st.lists(row, min_size=1, max_size=8), min_size=1, max_size=3)


@settings(max_examples=4, deadline=None)
@given(batches)
def test_upsert_matches_last_write_model(spark, bs):
    path = fresh_dir(spark, "fact")
    model = {}
    for b in bs:
        data = [(i, ts, plant, status) for i, (ts, plant, status) in enumerate(b)]
        src = spark.createDataFrame(
            data, f"{K.ROW_NO} long, timestamp timestamp_ntz, plant_name string, status string")
        UP.upsert(spark, CL.add_metadata(src, RUN_TS), path)
        for _, ts, plant, status in data:
            model[(ts, plant)] = status
    got = {(r.timestamp, r.plant_name): r.status for r in UP.read_table(spark, path).collect()}
    assert got == model
