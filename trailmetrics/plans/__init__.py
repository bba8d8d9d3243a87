"""The jobs: operators put together, from input tables to result tables."""
