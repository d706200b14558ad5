"""Structured Text programs as values: syntax, text, dependences, rewriting and graphical forms. Plain Python without Spark; `operators.programs` runs it in Arrow batches."""
