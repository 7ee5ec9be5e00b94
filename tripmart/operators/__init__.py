"""Row-level and aggregate operators over trip frames."""
