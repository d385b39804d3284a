"""matchloom: match-corpus building, checking and analysis on PySpark."""
