"""Reading and writing: samples, images, embeddings, result files."""
