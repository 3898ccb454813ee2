import json
import tempfile

from conftest import SF_SMALL
from panelops import cli
from panelops.plans.inputs import Inputs
from panelops.sources import files


def test_cli_ingest_validate_from_csv(spark, capsys):
    root = tempfile.mkdtemp(prefix="cli-", dir="/tmp")
    i = Inputs(spark, SF_SMALL)
    files.write_csv(i.facilities, f"{root}/fac")
    files.write_csv(i.raw, f"{root}/raw")
    common = ["--warehouse", f"{root}/wh", "--run-id", "r1", "--dag-logical-date", "2001-12-31",
              "--now", "2002-01-01 00:00:00"]
    assert cli.main(["ingest", *common, "--facilities-csv", f"{root}/fac",
                     "--reports-csv", f"{root}/raw"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["raw_rows"] == 819
    assert cli.main(["validate", *common, "--output-file", f"{root}/rep.json"]) == 0
    rep = json.loads(open(f"{root}/rep.json").read())
    assert (rep["clean_count"], rep["quarantined_count"]) == (768, 51)
