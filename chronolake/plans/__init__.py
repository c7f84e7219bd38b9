"""Jobs and read plans: refresh, snapshot build, time travel, comparison panel, rebuild,
registered queries and their oracle SQL."""
