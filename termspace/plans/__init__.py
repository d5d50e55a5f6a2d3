"""Pipeline stages and the training job."""
