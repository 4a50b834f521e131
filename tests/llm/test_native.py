import re

import pytest

from cantorel.llm import chat, pii

from .helpers import docs


@pytest.mark.parametrize("name", ["detect", "redact", "format"])
def test_no_python_on_the_main_path(spark, name):
    if name == "format":
        df = chat.format_conversations(spark.range(3).selectExpr("id as conv_id", "id as turn", "'user' as role", "'<|x' as text"))
    else:
        df = getattr(pii, name)(docs(spark, ["a@b.c"]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
