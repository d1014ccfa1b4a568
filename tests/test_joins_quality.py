from pyspark.sql import functions as F

from tidemart.operators.joins import left_join_defaults, or_join
from tidemart.operators.quality import (accepted_values, expect, not_null, orphans, run_checks,
                                        unique)


def _channels(spark):
    return spark.createDataFrame(
        [(1, "Google Organic", "organic"), (2, "Yandex Organic", "organic"), (3, "Google Ads", "google_ads"),
         (5, "Email Newsletter", "email")], "channel_sk int, channel_name string, channel_type string")


def test_or_join_matches_nested_loop_join(spark):
    s = spark.createDataFrame([(1, "ORGANIC"), (2, "google ads"), (3, "vk"), (4, ""), (5, "EMAIL")],
                              "sid int, utm string")
    ch = _channels(spark)
    got = sorted((r.sid, r.channel_sk) for r in or_join(s, "utm", ch, ["channel_name", "channel_type"],
                                                         "channel_sk").collect())
    cond = (F.lower(s.utm) == F.lower(ch.channel_name)) | (F.lower(s.utm) == F.lower(ch.channel_type))
    want = sorted((r.sid, r.channel_sk) for r in s.join(ch, cond, "left").collect())
    assert got == want
    assert (1, 1) in got and (1, 2) in got          # fan-out kept


def test_left_join_defaults_modes(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "a", 2.5)], "k int, s string, x double")
    ansi = sorted(tuple(r) for r in left_join_defaults(left, right, ["k"]).collect())
    dflt = sorted(tuple(r) for r in left_join_defaults(left, right, ["k"], "defaults").collect())
    assert ansi == [(1, "a", 2.5), (2, None, None)]
    assert dflt == [(1, "a", 2.5), (2, "", 0.0)]


def test_run_checks_counts(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", -1), (2, None, 3), (None, "zz", 0), (3, "zz", None)],
                               "id int, s string, q int")
    ref = spark.createDataFrame([(1,), (2,)], "id int")
    res = run_checks(df, [not_null("id"), unique("id"), accepted_values("s", ["a", "b"]),
                          expect("q_pos", "q > 0"), orphans("id", ref)])
    got = {r.pos: (r.check_name, r.violations, r.total) for r in res.collect()}
    assert got[0] == ("not_null", 1, 5)
    assert got[1] == ("unique", 1, 4)          # id 1 twice; NULL ignored
    assert got[2] == ("accepted_values", 1, 5)  # 'zz' once (distinct), NULL ignored
    assert got[3] == ("q_pos", 2, 5)           # -1 and 0; NULL passes
    assert got[4] == ("orphans", 1, 5)         # id 3
