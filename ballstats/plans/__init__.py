"""Named metrics, and jobs that compute several of them."""
