"""The command-line entry runs the whole analysis on CSV sources, with roles from a spec file."""

import orchards as O

from tabflow.__main__ import main


def test_cli_end_to_end(spark, tmp_dir):
    north = O.csv(tmp_dir, "n.csv", O.NORTH_COLS, O.random_rows(90, 4))
    south = O.csv(tmp_dir, "s.csv", O.SOUTH_COLS, O.random_rows(90, 5, south=True))  # the same plot numbers
    rc = main(["--spec", O.spec_file(tmp_dir), "--source", f"north={north}", "--source", f"south={south}",
               "--out", f"{tmp_dir}/out", "--quick", "--folds", "3", "--no-stack"])
    assert rc == 0
    combined = spark.read.parquet(f"{tmp_dir}/out/combined")
    assert combined.count() == 180
    assert {r.source for r in combined.select("source").distinct().collect()} == {"north", "south"}
    assert spark.read.parquet(f"{tmp_dir}/out/runs").count() == 1
    assert main(["--spec", O.spec_file(tmp_dir), "--source", f"X={tmp_dir}/missing.csv", "--out", f"{tmp_dir}/o2"]) == 2
