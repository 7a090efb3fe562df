"""DataFrame -> DataFrame operators of the pipeline. None of them starts a job."""
