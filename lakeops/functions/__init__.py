"""Column expressions: no function here triggers a job or leaves whole-stage codegen."""
