"""Table operators: quality gates, alignment, grids, augmentation, splits, models, metrics."""
