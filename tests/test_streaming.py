import tempfile

from ledgerline.streaming.intake import intake_warehouse, start_intake
from conftest import rows

HEADER = "adsh,cik,name,form,sic,filing_summary\n"


def _land(folder, name, lines):
    with open(f"{folder}/{name}", "w") as fh:
        fh.write(HEADER + "".join(l + "\n" for l in lines))


def test_intake_applies_batches_incrementally(spark):
    landing = tempfile.mkdtemp(prefix="ll-landing-")
    root = tempfile.mkdtemp(prefix="ll-stream-wh-")
    ckpt = tempfile.mkdtemp(prefix="ll-stream-ckpt-")
    _land(landing, "b1.csv", ["f1,1,Acme,10-K,1000,", "f2,2,Beta,10-Q,2000,",
                              "f3,1,Acme,10-Q,1000,"])

    def ts(epoch):
        return f"2025-01-{epoch + 1:02d} 00:00:00"

    q = start_intake(spark, landing, root, ts, checkpoint=ckpt)
    q.awaitTermination(120)
    wh = intake_warehouse(spark, root)
    assert rows(wh.table("companydim"), "cik", "name", "is_current") == [
        ("1", "Acme", True), ("2", "Beta", True)]
    assert wh.table("filingdim").count() == 3

    _land(landing, "b2.csv", ["f4,2,Beta Corp,10-K,2000,", "f5,3,Gamma,8-K,3000,"])
    q = start_intake(spark, landing, root, ts, checkpoint=ckpt)
    q.awaitTermination(120)
    comp = rows(wh.table("companydim"), "cik", "name", "is_current")
    assert comp == [("1", "Acme", True), ("2", "Beta", False), ("2", "Beta Corp", True),
                    ("3", "Gamma", True)]
    assert wh.table("filingdim").count() == 5
