"""Transit lakehouse on Spark: real-time feeds and static schedules to bronze, silver and star tables."""
