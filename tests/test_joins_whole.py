from rostrum.operators import members
from rostrum.plans import queries


def test_no_contact_synopsis_or_debate_is_left_out(spark, tiny):
    run = lambda name: queries.QUERIES[name](spark, tiny).collect()
    assert all(r["contact"] and r["synopsis"] for r in run("member_detail_merge_whole"))
    assert all(r["synopsis"] for r in run("member_synopsis_whole"))
    assert all(r["watched"] for r in run("transcript_with_watch_whole"))


def test_missing_right_hand_rows(spark):
    people = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    contact = spark.createDataFrame([(1, "x")], "id long, contact string")
    synopsis = spark.createDataFrame([(2, "y")], "id long, synopsis string")
    got = sorted((r["id"], r["contact"], r["synopsis"]) for r in members.detail(people, contact, synopsis).collect())
    assert got == [(1, "x", None), (2, None, "y")]
