"""clickflow: click-stream and ad-click analytics as Spark DataFrame / SQL / Structured Streaming jobs."""
