"""End-to-end runs: from flow and weather tables to day sets and evaluated classifiers."""
