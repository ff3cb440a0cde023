"""terrabrook.operators"""
