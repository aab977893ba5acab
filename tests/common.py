"""What several tests of the library use. Not in conftest.py, whose name other test folders have too."""

SMALL = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
