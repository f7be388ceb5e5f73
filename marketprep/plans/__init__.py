"""End-to-end plans: the two report jobs and the driver-table query catalog."""
