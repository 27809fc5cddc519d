"""The lake's queries over the test tables, with equivalent SQL for each."""
