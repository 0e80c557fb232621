"""Filters and cleaning (F1-F5, X3, X2) through the panel build."""

from panelgrowth.plans.panels import clean_state_metro, split_state_metro

RAW = ("area_name string, state_name string, supersector_name string, industry_name string, "
       "period string, year string, value string, data_type_code string, seasonal string")


def test_state_metro_panel_rules(spark):
    rows = [("A Metropolitan Division", "X", "ss", "TN", "M01", "2001", "1", "1", "U"),
            ("B NECTA Division", "X", "ss", "TN", "M01", "2001", "1", "1", "U"),
            ("C NECTA", "X", "ss", "TN", "M01", "2001", "2", "1", "U"),
            ("D Metropolitan Statistical Area", "X\r", "ss\r", "TN", "M02", "2001", " 3", "01", "S"),
            ("E", None, "ss", "TN", "M03", "2001", "4", "1", "U"),              # NULL state kept
            ("F", "Puerto Rico", "ss", "TN", "M03", "2001", "5", "1", "U"),     # excluded state
            ("G", "X", "ss", "TN", "M13", "2001", "6", "1", "U"),               # annual average
            ("H", "X", "ss", "TN", "M04", "2001", "7", "2", "U"),               # other data type
            ("I", "X", "ss", "TN", "M04", "2001", "-", "1", "U")]               # bad value -> NULL
    panel = split_state_metro(clean_state_metro(spark.createDataFrame(rows, RAW)))
    got = sorted((r["area_name"], r["state_name"], r["supersector_name"], r["Month"], r["value"])
                 for r in panel.collect())
    assert got == [("C", "X", "ss", "01", 2.0), ("D ", "X", "ss", "02", None), ("E", None, "ss", "03", 4.0),
                   ("I", "X", "ss", "04", None)]


def test_value_text_is_parsed_after_feed_strip(spark):
    rows = [("C NECTA", "X", "ss", "TN", "M01", "2001", "12.5", "1", "U")]
    panel = split_state_metro(clean_state_metro(spark.createDataFrame(rows, RAW)))
    assert panel.first()["value"] == 12.5
