"""Run-level plan: execute a queue, assemble and append its results."""
