import os
import re

import pytest

import __spark_entry__ as entry
from tests import oracle

SF = "/root/testdata/sf0.01"
QUICK = ["B9_registry_check", "C6_site_variables", "D7_name_match", "E8_station_pairs", "F10_order_segments", "G5_complete_weeks", "H7_unit_hint", "I1_percentile_rank", "J9_clip_to_box", "K3_changes"]


def test_every_query_has_its_sql():
    own = [n for n in entry.queries() if not re.match(r"op\d+_|pipeline$", n)]
    assert set(own) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_every_operator_of_the_survey_has_a_query():
    listed = {"A": 35, "B": 15, "C": 17, "D": 13, "E": 10, "F": 10, "G": 14, "H": 10, "I": 29, "J": 42, "K": 5}
    want = {f"{k}{i}" for k, n in listed.items() for i in range(1, n + 1)} - {"C11", "J11"}
    have = {re.match(r"([A-K]\d+)_", n).group(1) for n in entry.queries() if re.match(r"[A-K]\d+_", n)}
    assert want - have == set()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", QUICK)
def test_query_agrees_with_its_sql(spark, name):
    problems, n = oracle.compare(spark, oracle.connect(SF), entry.queries()[name], entry.oracle_sql()[name], SF)
    assert not problems and n > 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_entry_returns_rows(spark):
    assert entry.entry(spark).columns == ["segment", "week_start", "mean_cfs", "n_gauges", "min_cfs", "max_cfs"]
    assert entry.entry(spark).count() > 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_the_overview_works_out_its_tables_once(spark):
    """Its parts read the copies, the chosen days and the weeks from the shared folder, not from the readings again."""
    assert not [f for f in entry.queries()["J36_overview"](spark, "/root/testdata/sf0.001").inputFiles() if "lineitem" in f]
