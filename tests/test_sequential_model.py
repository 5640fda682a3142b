"""The set-based transitions equal running pre / (error) / post run after run.

A plain-Python replay of the loader's procedures, one run at a time in start
order, over the sf0.001 control fixtures (one run per order, orders with status
'F' fail in their batch), compared with the registered set-based queries.
"""

import __spark_entry__ as E
from conftest import SF_SMALL
from lakeloom import fixtures as fx

AS_OF = fx.AS_OF


def _replay(tables, spark):
    det = {(r.sourceid, r.dataflowflag): r.asDict() for r in fx.control_detail(tables).collect()}
    hdr = {r.sourceid: r.asDict() for r in fx.control_header(tables).collect()}
    grp = {r.sourceid: r.asDict() for r in fx.source_groups(tables).collect()}
    failed_orders = {r.o_orderkey for r in tables.orders.where("o_orderstatus = 'F'").collect()}
    reqs = sorted(fx.run_requests(tables).collect(), key=lambda r: (r.loadstarttime, r.runid))
    audit, errors = [], []
    for q in reqs:
        s, f, t = q.sourceid, q.dataflowflag, q.targetobject
        d = det.get((s, f))
        d = d if d and d["targetobject"] == t else None
        h, g = hdr[s], grp[s]
        # pre-process
        batch = None
        if d and d["isapplicable"] == 1:
            batch = (d["latestbatchid"] or 0) + 1
            d["latestbatchid"], d["flowstatus"] = batch, "Started"
            audit.append({"sourceid": s, "dataflowflag": f, "targetobject": t, "latestbatchid": batch,
                          "flowstatus": "Started", "srcrwcnt": 0, "tgtinscnt": None, "tgtupdcnt": None,
                          "loadendtime": None})
        if h["isapplicable"] == 1:
            h["status"], h["lastupdateddate"] = "Started", AS_OF
        if f == "raw_to_bronze" and g["schemaname"] == "dwh" and g["isapplicable"] == 1:
            g["status"], g["loadstartdatetime"] = "Started", AS_OF
        # error transition (the load failed)
        if q.runid in failed_orders:
            if d is not None:
                errors.append((s, f, t, d["latestbatchid"]))
                if batch is not None and d["latestbatchid"] == batch:
                    d["flowstatus"] = "Failed"
            h["status"] = "Failed"
            for a in audit:
                if (a["sourceid"], a["dataflowflag"], a["targetobject"], a["latestbatchid"]) == (s, f, t, batch):
                    a["flowstatus"] = "Failed"
        # post-process
        failed = batch is not None and (s, f, t, batch) in errors
        app = lambda x: x is not None and x["isapplicable"] == 1
        src_d, brn_d = det.get((s, "raw_to_bronze")), det.get((s, "bronze_to_silver"))
        if not failed:
            if f == "raw_to_bronze":
                if app(src_d):
                    src_d["isreadyforexecution"] = 0
                if h["isapplicable"] == 1:
                    h["status"], h["lastupdateddate"] = "Started", AS_OF
                if app(brn_d):
                    brn_d["isreadyforexecution"] = 1
            if f == "bronze_to_silver":
                if h["isapplicable"] == 1:
                    h["status"], h["lastupdateddate"] = "Completed", AS_OF
                if app(brn_d) and brn_d["targetobject"] == t:
                    brn_d["isreadyforexecution"] = 0
                if app(src_d):
                    src_d["isreadyforexecution"] = 1
                if g["schemaname"] == "dwh" and g["isapplicable"] == 1:
                    g["status"], g["lastrundatetime"], g["loadenddatetime"] = "Completed", AS_OF, AS_OF
            if app(d) and batch is not None and d["latestbatchid"] == batch:
                d["flowstatus"], d["etllastrundate"] = "Completed", AS_OF
        else:
            if h["isapplicable"] == 1:
                h["status"], h["lastupdateddate"] = "Failed", AS_OF
            if app(d) and d["latestbatchid"] == batch:
                d["flowstatus"] = "Failed"
            if g["schemaname"] == "dwh" and g["isapplicable"] == 1:
                g["status"], g["loadenddatetime"] = "Failed", AS_OF
        for a in audit:
            if batch is not None and (a["sourceid"], a["dataflowflag"], a["targetobject"], a["latestbatchid"]) == (s, f, t, batch):
                a.update(srcrwcnt=q.srccnt, tgtinscnt=q.inscnt, tgtupdcnt=q.updcnt,
                         flowstatus="Failed" if failed else "Completed", loadendtime=AS_OF)
    return det, hdr, grp, audit


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_set_based_equals_sequential(spark, tables):
    det, hdr, grp, audit = _replay(tables, spark)
    q = E.queries()
    dcols = ["sourceid", "dataflowflag", "targetobject", "latestbatchid", "flowstatus",
             "isreadyforexecution", "etllastrundate"]
    assert _rows(q["detail_after_post"](spark, SF_SMALL), dcols) == sorted(
        tuple(d[c] for c in dcols) for d in det.values())
    hcols = ["sourceid", "status", "lastupdateddate"]
    assert _rows(q["header_after_post"](spark, SF_SMALL), hcols) == sorted(
        tuple(h[c] for c in hcols) for h in hdr.values())
    gcols = ["sourceid", "status", "lastrundatetime", "loadstartdatetime", "loadenddatetime"]
    assert _rows(q["groups_after_post"](spark, SF_SMALL), gcols) == sorted(
        tuple(g[c] for c in gcols) for g in grp.values())
    acols = ["sourceid", "dataflowflag", "targetobject", "latestbatchid", "flowstatus", "srcrwcnt",
             "tgtinscnt", "tgtupdcnt", "loadendtime"]
    assert _rows(q["audit_after_post"](spark, SF_SMALL), acols) == sorted(
        tuple(a[c] for c in acols) for a in audit)
