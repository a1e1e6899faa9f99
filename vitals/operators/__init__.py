"""DataFrame-to-DataFrame operators. Stateless ones serve batches and streams alike."""
