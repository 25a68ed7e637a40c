"""Writers: dated snapshots with a snapshot log, layout, threshold upserts."""
