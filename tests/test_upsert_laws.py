"""Property tests (hypothesis) of the upsert laws on small random tables."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeloom.operators.upsert import upsert

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1)
META = {"etljobname": "j", "envsourcecd": "e", "datasourcecd": "d"}
SCHEMA = ("tkey long, k long, v long, etlactiveind int, etljobname string, envsourcecd string, "
          "datasourcecd string, etlcreateddatetime timestamp_ntz, etlupdateddatetime timestamp_ntz")

keys = st.one_of(st.none(), st.integers(min_value=0, max_value=30))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(tkeys=st.lists(st.integers(min_value=0, max_value=30), max_size=12, unique=True),
       tnulls=st.integers(min_value=0, max_value=2),
       src=st.lists(st.tuples(keys, st.integers(min_value=0, max_value=9)), max_size=12,
                    unique_by=lambda x: x[0] if x[0] is not None else object()))
def test_upsert_laws(spark, tkeys, tnulls, src):
    trows = [(i + 1, k, 0, 1, "o", "o", "o", T0, T0) for i, k in enumerate(tkeys)]
    trows += [(len(tkeys) + i + 1, None, 0, 1, "o", "o", "o", T0, T0) for i in range(tnulls)]
    target = spark.createDataFrame(trows, SCHEMA)
    source = spark.createDataFrame(src, "k long, v long")
    r = upsert(target, source, ["k"], surrogate="tkey", meta=META, as_of=T1)
    out = r.table.collect()
    c = r.counts().collect()[0]
    matched = {k for k, _ in src if k is not None and k in set(tkeys)}
    # counts: every source row is an update or an insert; NULL keys always insert
    assert c.srccnt == len(src)
    assert c.updcnt == len(matched)
    assert c.inscnt == len(src) - len(matched)
    # row count: target + inserts, nothing deleted
    assert len(out) == len(trows) + c.inscnt
    # surrogate keys: unique, old ones kept, new ones dense after the old maximum
    sk = [x.tkey for x in out]
    assert len(set(sk)) == len(sk)
    new = sorted(x.tkey for x in out if x.etlcreateddatetime == T1)
    assert new == list(range(len(trows) + 1, len(trows) + 1 + c.inscnt))
    # updated rows carry the source value and the new audit values
    sv = {k: v for k, v in src if k is not None}
    for x in out:
        if x.k in matched:
            assert x.v == sv[x.k] and x.etlupdateddatetime == T1 and x.etlcreateddatetime == T0
