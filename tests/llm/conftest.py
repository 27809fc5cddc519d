from tests.llm.data import crowded, docs  # noqa: F401
