"""strandloom: genome-annotation analytics and table cleaning as Spark DataFrame jobs."""
