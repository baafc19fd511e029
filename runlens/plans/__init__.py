"""Multi-operator plans: dataset builds, leaderboards and the driver's query catalog."""
