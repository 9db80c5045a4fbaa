"""Small inputs and plan text for the tests."""

import datetime
from decimal import Decimal

from salesmill.plans.clean import add_profit_margin, add_time_features
from salesmill.schema import RENAME

HEADERS = list(RENAME)


def csv_row(**values):
    """One raw row by header, with defaults for what a test does not care about."""
    row = {
        "Region": "Asia",
        "Country": "Japan",
        "Item Type": "Meat",
        "Sales Channel": "Online",
        "Order Priority": "M",
        "Order Date": "1/7/2010",
        "Order ID": "1",
        "Ship Date": "1/9/2010",
        "Units Sold": "10",
        "Unit Price": "2.50",
        "Unit Cost": "1.50",
        "Total Revenue": "25.00",
        "Total Cost": "15.00",
        "Total Profit": "10.00",
    }
    row.update({key.replace("_", " "): value for key, value in values.items()})
    return row


def write_raw_csv(path, rows, headers=HEADERS):
    lines = [",".join(headers)]
    lines += [",".join(row.get(h, "") for h in headers) for row in rows]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


FACT_SCHEMA = (
    "country string, item_type string, sales_channel string, order_priority string,"
    " order_date date, ship_date date, units_sold int,"
    " total_revenue decimal(14,4), total_profit decimal(14,4)"
)


def make_fact(spark, rows):
    """A fact of (country, item, channel, priority, order date, ship date, units, rev, profit)."""

    def date(text):
        return datetime.date.fromisoformat(text) if text else None

    def money(text):
        return None if text is None else Decimal(text)

    typed = [
        (c, i, s, p, date(od), date(sd), units, money(rev), money(prof))
        for c, i, s, p, od, sd, units, rev, prof in rows
    ]
    return add_profit_margin(add_time_features(spark.createDataFrame(typed, FACT_SCHEMA)))


def collect(df):
    return [tuple(row) for row in df.collect()]


def final_plan(df):
    """The physical plan that ran, after adaptive execution."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
