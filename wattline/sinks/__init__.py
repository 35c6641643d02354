"""Table writes: day-partitioned layout, full and per-day replacement, batch appends."""
