"""terrabrook.functions"""
