from rostrum.plans import queries
from rostrum.sources.documents import read_table


def test_the_whole_table_is_the_state(spark, tiny):
    customers = {r[0] for r in read_table(spark, tiny, "customer").select("c_custkey").collect()}
    parts = {r[0] for r in read_table(spark, tiny, "part").select("p_partkey").collect()}
    assert len(customers) > 50 and parts - customers and parts & customers
    added = [r["id"] for r in queries.QUERIES["watchlist_add_whole"](spark, tiny).collect()]
    assert len(added) == len(set(added)) and set(added) == customers | parts
    left = {r["id"] for r in queries.QUERIES["watchlist_remove_whole"](spark, tiny).collect()}
    assert left == customers - {3, 7, 1000}
