"""DataFrame to DataFrame operators the models are made of."""
