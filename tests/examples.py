"""The reference's spec processors and flows, defined with lineflow (FIXTURES 1)."""

from lineflow import dataflow, from_json, identity, interpolate, register, repeat, skip

simple = register("simple", identity())
skipped = register("skipped", skip())
multi = register("multi", repeat(3))
test_example = register("test_example", interpolate("I raised the {foo}", "test_example"))
flow = dataflow("flow", from_json(), "test_example")
