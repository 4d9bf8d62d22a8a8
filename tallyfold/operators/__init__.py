"""Row checks, per-file metrics and roll-ups as DataFrame operators."""
