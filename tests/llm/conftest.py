from conftest_llm import none, odd, schema, texts  # noqa: F401
