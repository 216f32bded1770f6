"""Every registered query beside its SQL, whole and with groups cut into pieces."""

import harness
import pytest
from driftline.plans import catalog

SF = "/root/testdata/sf0.001"
CUT = ["n3_assign_levels", "w1_skill_windows_until", "c9_debug_windows", "v3_claim_support_tables", "v6_attach_evidence",
       "g4_trajectory_anomaly", "a1_build_graph", "a11_error_lookback", "a16_flow_view"]


@pytest.fixture(scope="module")
def con():
    return harness.oracle(SF)


def test_sql_is_for_registered_queries():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query(spark, con, name):
    assert harness.compare(catalog.QUERIES[name](spark, SF), con, catalog.ORACLES[name]) is None


@pytest.mark.parametrize("name", CUT)
def test_query_in_pieces(spark, con, cut_groups, name):
    cut_groups(30)
    assert harness.compare(catalog.QUERIES[name](spark, SF), con, catalog.ORACLES[name]) is None
