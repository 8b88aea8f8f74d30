"""One tagger for all tests: learning takes a while."""

from functools import cache

from conftest import SF

from dyelake.llm import pii
from dyelake.sources.tables import table


@cache
def tagger_of(spark):
    return pii.learn(table(spark, SF.replace("sf0.001", "sf0.01"), "documents"))
