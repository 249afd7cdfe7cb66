"""Every family of registered queries against its SQL at the smallest scale."""

import math
import os

import duckdb
import pytest

from weekmart.catalog import load

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()
CHOSEN = (
    "a1_densify a3_last_year a15_analyze a15b_analyze_observed a17_segment_report a19_share_of_week a20_last_26_weeks "
    "a21_several_grains b1_sellin_extract b4_sales_with_fulfilment b6_financial_extract b9_prepare_sellin b12_compare c1_text_to_number "
    "c5_clean_city d1_unmapped_segments d6_welch_test e5_fiscal_calendar e7_iso_week_and_year g5_profile_columns g9_percent_change "
    "g14_totals_and_members h1_replace_weeks h3_latest_file_wins j2_map_case_insensitive j12_state_or_none k4_replace_distributor "
    "m4_inventory m5_fair_share r1_distributor_model r2_national_report_model r4_canada_one_file_model s1_read_regional_report s6_folders_by_name "
    "s8_date_in_last_header t1_conform_regional_us t2_conform_national_report t5_conform_canada_one x1_stream_append_missing"
).split()


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("test tables are not here")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, con, name):
    q = load()[name]
    df = q.run(spark, SF)
    result = con.execute(q.sql)
    columns = sorted(c[0] for c in result.description)
    assert sorted(df.columns) == columns
    theirs = ordered(result.df()[columns].astype(object).where(lambda x: x.notna(), None).itertuples(index=False, name=None))
    ours = ordered(df.select(*[f"`{c}`" for c in columns]).toPandas().astype(object).where(lambda x: x.notna(), None).itertuples(index=False, name=None))
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs):
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, float):
                assert math.isclose(x, y, rel_tol=1e-12, abs_tol=1e-12)
            else:
                assert str(x).removesuffix(" 00:00:00") == str(y).removesuffix(" 00:00:00") or float(x) == float(y)


def test_every_query_has_sql():
    assert [n for n, q in load().items() if q.sql is None] == []
