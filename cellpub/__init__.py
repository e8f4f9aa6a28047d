"""cellpub: register statistics, disclosure control and publication as Spark jobs."""
