"""Writers: datasets, month partitions, metric files, versioned snapshots."""
