"""The silver, gold and report models, and the code that runs whole layers."""
