"""Dense array kernels that run inside Arrow batches, one frame at a time."""
