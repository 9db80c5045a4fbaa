import pytest

from golden import golden  # noqa: F401
from helpers import collect, make_fact
from salesmill.operators import first_last_growth, share_of_total, top_k
from salesmill.plans.kpi import KPIS, kpi_table
from salesmill.plans.mart import MART_QUERIES, query_columns, query_fact, query_tables
from salesmill.sources.sinks import mart_tables, publish_tables, write_tables_parquet
from salesmill.sources.star import sales_fact

BEST = ("2013-10", 1672472823.19, 498536665.12, 34.52359482758613)

# Answers that follow from the published results.
EXPECTED = {
    "q01_best_month_revenue": [BEST],
    "q02_best_month_profit": [BEST],
    "q03_channel_revenue_share": [
        ("Online", 66856341348.54994, 50.04),
        ("Offline", 66750331717.85986, 49.96),
    ],
    "q04_channel_profit_share": [
        ("Online", 19717124010.950024, 50.03),
        ("Offline", 19691999718.660004, 49.97),
    ],
    "q05_most_profitable_country": [("Sudan", 814145709.2699999, 249523548.61)],
    "q08_most_profitable_item": [
        ("Cosmetics", 8370, 41924464, 18329375660.800034, 7289406555.68, 39.770000000000834)
    ],
    "q09_priority_revenue_share": [
        ("M", 33651990941.98004, 25.19),
        ("L", 33352231464.369972, 24.96),
        ("H", 33348094607.259937, 24.96),
        ("C", 33254356052.800003, 24.89),
    ],
    "q10_priority_profit_share": [
        ("M", 9882278290.920008, 25.08),
        ("H", 9847178436.499998, 24.99),
        ("L", 9845307974.819992, 24.98),
        ("C", 9834359027.370022, 24.95),
    ],
    "q11_snapshot": [(100000, 133606673066.41025, 39409123729.610054, 34.327819400002944)],
    "q12_growth_first_last": [
        ("2010-01", 1431090213.3200004, "2017-07", 1445914072.13, 1.04)
    ],
}


@pytest.mark.parametrize("name", EXPECTED)
def test_published_answers(golden, name):  # noqa: F811
    assert collect(query_tables(name, golden)) == EXPECTED[name]


def test_published_rankings(golden):  # noqa: F811
    by_profit = [r[0] for r in collect(query_tables("q06_countries_by_profit", golden))]
    assert by_profit == [
        "Sudan",
        "Hungary",
        "Federated States of Micronesia",
        "Liberia",
        "New Zealand",
        "Bahrain",
        "Marshall Islands",
        "Malta",
        "Panama",
        "Yemen",
    ]
    items = query_tables("q07_items_by_revenue", golden)
    assert items.columns == ["item_type", "revenue", "profit", "avg_profit_margin_pct"]
    assert [r[0] for r in collect(items)] == [r[0] for r in collect(golden["item_kpi"])]
    unordered = query_tables("q13_share_unordered", golden)
    assert sorted(collect(unordered)) == sorted(EXPECTED["q03_channel_revenue_share"])


# SQL of a user on the published tables: question, and SQL with the same answer.
SQL = {
    "q01_best_month_revenue": """
        SELECT * FROM {db}.monthly_kpi
        WHERE monthly_revenue = (SELECT max(monthly_revenue) FROM {db}.monthly_kpi)""",
    "q04_channel_profit_share": """
        SELECT c.sales_channel, c.profit, round(100 * c.profit / t.whole, 2)
        FROM {db}.channel_kpi AS c
        CROSS JOIN (SELECT sum(profit) AS whole FROM {db}.channel_kpi) AS t
        ORDER BY c.profit DESC""",
    "q11_snapshot": "SELECT * FROM {db}.summary",
    "q12_growth_first_last": """
        SELECT lo, min_by(monthly_revenue, order_year_month), hi,
               max_by(monthly_revenue, order_year_month),
               round(100 * (max_by(monthly_revenue, order_year_month)
                            / min_by(monthly_revenue, order_year_month) - 1), 2)
        FROM {db}.monthly_kpi
        JOIN (SELECT min(order_year_month) AS lo, max(order_year_month) AS hi
              FROM {db}.monthly_kpi)
        GROUP BY lo, hi""",
}


def test_sql_text_on_published_tables(spark, golden, tmp_path):  # noqa: F811
    out = str(tmp_path / "out folder")
    write_tables_parquet(golden, out)
    publish_tables(spark, out, "kpi")
    tables = mart_tables(spark, "kpi")
    assert list(tables) == list(KPIS)
    for name, sql in SQL.items():
        assert collect(spark.sql(sql.format(db="kpi"))) == collect(query_tables(name, tables))


@pytest.mark.parametrize("name", MART_QUERIES)
def test_narrowed_fact_gives_the_same_answer(spark, sf_dir, name):
    query = MART_QUERIES[name]
    narrow = query_fact(name, sales_fact(spark, sf_dir, query_columns(name)))
    whole = query_tables(name, {query.kpi.name: kpi_table(sales_fact(spark, sf_dir), query.kpi)})
    assert narrow.columns == whole.columns
    if name == "q13_share_unordered":
        assert sorted(collect(narrow)) == sorted(collect(whole))
    else:
        assert collect(narrow) == collect(whole)


def test_undated_revenue_is_the_last_month(spark):
    rows = [
        ("A", "x", "Online", "M", "2010-01-05", None, 1, "10.00", "1"),
        ("A", "x", "Online", "M", None, None, 1, "15.00", "1"),
        ("A", "x", "Online", "M", "2010-03-05", None, 1, "12.00", "1"),
    ]
    assert collect(query_fact("q12_growth_first_last", make_fact(spark, rows))) == [
        ("2010-01", 10.0, None, 15.0, 50.0)
    ]


def test_growth_edges(spark):
    def growth(rows):
        df = spark.createDataFrame(rows, "k string, v double")
        return collect(first_last_growth(df, "k", "v", "key", "value"))

    assert growth([]) == [(None, None, None, None, None)]
    assert growth([("a", 0.0), ("b", 1.0)]) == [("a", 0.0, "b", 1.0, None)]
    assert growth([("a", 4.0)]) == [("a", 4.0, "a", 4.0, 0.0)]
    assert growth([("a", None), ("b", 1.0)]) == [("a", None, "b", 1.0, None)]
    assert growth([(None, 3.0)]) == [(None, 3.0, None, 3.0, 0.0)]


def test_share_edges(spark):
    def shares(rows):
        df = spark.createDataFrame(rows, "k string, v double")
        return collect(share_of_total(df, "v", "share").orderBy("k"))

    assert shares([]) == []
    assert shares([("a", 0.0), ("b", 0.0)]) == [("a", 0.0, None), ("b", 0.0, None)]
    assert shares([("a", 1.0), ("b", None), ("c", 2.0)]) == [
        ("a", 1.0, 33.33),
        ("b", None, None),
        ("c", 2.0, 66.67),
    ]


def test_null_measure_ranks_first_in_the_mart(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 1.0)], "k string, v double")
    assert collect(top_k(df, "v", "k", 1, nulls_first=True)) == [("b", None)]
    assert collect(top_k(df, "v", "k", 2)) == [("a", 1.0), ("c", 1.0)]
