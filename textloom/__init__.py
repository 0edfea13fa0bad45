"""textloom: Spark jobs for preparing fine-tuning text and reading training logs."""
