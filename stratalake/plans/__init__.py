"""The repair business: bronze, silver and gold tables and the job that refreshes them."""
