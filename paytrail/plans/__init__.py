"""Silver tables, gold marts, the staged pipeline and the driver-table workload."""
