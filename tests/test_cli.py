"""The command-line jobs chained end to end on a landed mini-feed."""

from __future__ import annotations

import datetime as dt
import uuid

from aerostat import cli
from tests.conftest import flight, weather, write_feed


def test_day_in_zone():
    now = dt.datetime(2024, 1, 3, 17, 30, tzinfo=dt.timezone.utc)  # 00:30 on the 4th in Bangkok
    assert cli.day_in_zone(0, now=now) == dt.date(2024, 1, 4)
    assert cli.window(7, dt.date(2024, 1, 15)) == (dt.date(2024, 1, 8), dt.date(2024, 1, 15))


def test_jobs_chain(spark, workdir, capsys):
    for day in ("2025-04-01", "2025-04-02"):
        write_feed(workdir, "flight", day, [flight(f"F{day[-1]}", "BKK", "NRT", f"{day}T08:00:00", "ANA"),
                                            flight(f"G{day[-1]}", "BKK", "HND", f"{day}T09:00:00", None)])
        write_feed(workdir, "weather", day, [weather("Tokyo", temp=10)])
    clean, table = f"{workdir}/clean", f"fw_{uuid.uuid4().hex[:8]}"
    days = ["--day", "2025-04-01", "--day", "2025-04-02"]
    assert cli.main(["transform", "--raw", workdir, "--clean", clean, *days], spark) == 0
    assert cli.main(["load", "--clean", clean, "--serving", f"{workdir}/serving", *days], spark) == 0
    assert spark.read.parquet(f"{workdir}/serving").count() == 4
    assert cli.main(["backfill", "--clean", clean, "--table", table, "--table-root", f"{workdir}/t",
                     "--end", "2025-04-02", "--days-back", "1"], spark) == 0
    assert spark.table(table).count() == 4
    assert cli.main(["report", "--clean", clean], spark) == 0
    assert cli.main(["dashboard", "--table", table, "--day", "2025-04-02", "--city", "Tokyo"], spark) == 0
    assert cli.main(["dashboard", "--serving", f"{workdir}/serving"], spark) == 0
    assert cli.main(["dashboard", "--serving", f"{workdir}/serving", "--day", "2025-04-02", "--city", "Tokyo"], spark) == 0
    assert cli.main(["absent", "--clean", clean, "--end", "2025-04-03", "--days-back", "3"], spark) == 0
    assert cli.main(["profile", "--clean", clean], spark) == 0
    assert cli.main(["transform", "--raw", workdir, "--clean", f"{workdir}/again", "--split-arrays", *days], spark) == 0
    out = capsys.readouterr().out
    said = [[c.strip() for c in line.split("|")[1:-1]] for line in out.splitlines() if line.startswith("|")]
    assert ["flights_vs_temp", "Tokyo", "1", "10.0"] in said and ["flights_per_airline", "ANA", "1", "NULL"] in said
    absent = out.partition("== absent days")[2].partition("==")[0]
    assert [x.strip("| ") for x in absent.splitlines() if x.startswith("|2025-")] == ["2025-03-31", "2025-04-03"]
    assert [r[:7] for r in said if r[1:2] == ["airline"]] == [["4", "airline", "string", "4", "2", "ANA", "ANA"]]
    assert out.count("wrote 4 clean rows") == 2
    assert "wrote 4 clean rows" in out and "flights_per_airline" in out and "by_airline" in out
