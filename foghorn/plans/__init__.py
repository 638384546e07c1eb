"""Domain plans composed from operators: scoring, rollup, matching, sampling."""
